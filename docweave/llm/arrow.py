"""Map one column of a table through an Arrow function, whatever the other columns."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_column(docs: DataFrame, made: T.StructType, function, column, keep=True) -> DataFrame:
    """`docs` with the columns `made`; `function(position, width)` gives the map
    function, which gets the other columns by position, so that clashing or odd names do
    not matter, and returns the first `width` of them. A column of `docs` that has the
    name of a made one is replaced. Without `keep`, `column` is not in the result and
    does not travel back from the tasks' Python."""
    kept = [f for f in docs.schema.fields if f.name not in made.names or f.name == column]
    if not keep:  # It goes last, after what is returned.
        kept.sort(key=lambda f: f.name == column)
    rows = docs.select(*[docs[f"`{f.name}`"] for f in kept])
    position = [f.name for f in kept].index(column)
    sent = rows.toDF(*[str(i) for i in range(len(kept))])
    kept = kept if keep else kept[:position]
    fields = [T.StructField(str(i), f.dataType, True) for i, f in enumerate(kept)]
    n = len(kept)
    schema = T.StructType(fields + [T.StructField(str(n + i), f.dataType, True) for i, f in enumerate(made.fields)])
    out = sent.mapInArrow(function(position, n), schema)
    names = [f.name for f in kept] + made.names
    return out.toDF(*names).drop(column) if keep and column in made.names else out.toDF(*names)
