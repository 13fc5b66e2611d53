"""Count the tokens of a unigram vocabulary, without making them.

Words (cut before each run of blanks, blanks shown as marks; with `split` before each
blank, as some tokenizers do first) are looked up in a table of those met before. Where
the vocabulary has pieces that go on past such a cut, the text is one word. For a new word, an Aho-Corasick automaton lists all vocabulary pieces that
end at each character, longest first, and a dynamic programme carries, for each
position, the best score and its number of pieces. Ties go to the longest last piece,
a character without a piece costs the lowest score less ten and counts as its UTF-8
bytes where the vocabulary has them: the rules of the usual unigram tokenizers, against
which the tests compare.

One pass over the scan, no shuffle. Memory: the vocabulary, the words remembered
(`KNOWN_WORDS` at most) and the longest text.

Defined cases: a null or empty text has 0 tokens; pieces of several marks match runs of
blanks, but with `split` each blank of a run is a word of its own; repeated rows get a count each; other columns pass through (the result column
replaces one of its name); an empty table gives an empty table.
"""

import gc
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docweave.llm.arrow import map_column
from docweave.session import spread_if_few

# How unigram tokenizers show a blank; cost of an unknown character; form
# of byte pieces.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
BYTE_PIECE = "<0x{:02X}>"

KNOWN_WORDS = 500_000

_RUN_AND_WORD = re.compile(f"{MARK}+[^{MARK}]*")


def read_pieces(path):
    """(piece, score) of a sentencepiece file, in the order of ids.

    The public file holds ranks of merges, not log-probabilities; a piece of rank r gets
    -ln(r + 10), as frequencies fall about as one over the rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), -math.log(i + 10.0)) for i in range(model.get_piece_size())]


class Counter:
    """Counts tokens of words, with those met before; kept by a task."""

    def __init__(self, pieces, known_words=KNOWN_WORDS, split=True):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        scores = {}
        for piece, score in pieces:
            scores[piece] = score
        for piece, score in scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.by_bytes = all(BYTE_PIECE.format(b) in scores for b in range(256))
        self.known, self.known_words = {}, known_words
        self.split = split
        # No best segmentation crosses the start of a run of marks: none of its pieces does,
        # and a mark is never an unknown character that could merge with the one before.
        self.cut = MARK in scores and not any(MARK in piece.lstrip(MARK) for piece in scores)

    def pieces(self, word):
        """Number of pieces of the best segmentation."""
        n = len(word)
        best, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)

        def close(end, single, reached):
            # The unknown character comes last among what ends here, as its start does.
            if single:
                return
            score = best[end - 1] + self.unknown
            if not reached or score > best[end]:
                best[end] = score
                unknown[end] = True
                if self.by_bytes:
                    count[end] = count[end - 1] + len(word[end - 1].encode("utf-8"))
                else:
                    count[end] = count[end - 1] + (not unknown[end - 1])

        single = reached = False
        end = 1
        for last, (length, piece_score) in self.automaton.iter(word):
            if last + 1 != end:
                close(end, single, reached)
                for gap in range(end + 1, last + 1):
                    close(gap, False, False)
                end, single, reached = last + 1, False, False
            start = end - length
            score = best[start] + piece_score
            if not reached or score > best[end]:
                best[end], count[end], reached = score, count[start] + 1, True
            single = single or length == 1
        if n:
            close(end, single, reached)
            for gap in range(end + 1, n + 1):
                close(gap, False, False)
        return count[n]

    def count(self, text):
        if not text:
            return 0
        text = text.replace(MARK, " ")
        if not self.split and not self.cut:
            text = text.replace(" ", MARK)
            return self.pieces(text if text[0] == MARK else MARK + text)
        if self.split or "  " not in text:
            words = text.split(" ")
            if not words[0]:
                del words[0]
        else:
            marked = text.replace(" ", MARK)
            words = [run[1:] for run in _RUN_AND_WORD.findall(marked if marked[0] == MARK else MARK + marked)]
        known = self.known
        for word in set(words).difference(known):
            known[word] = self.pieces(MARK + word)
        total = sum(map(known.__getitem__, words))
        if len(known) > self.known_words:
            known.clear()
        return total


def _counts(pieces, split, position, width):
    def run(batches):
        gc.disable()  # no cycles arise, and looking for them among the words takes long
        counter = Counter(pieces.value, split=split)
        for batch in batches:
            found = [counter.count(value.as_py()) for value in batch.column(position)]
            arrays = [batch.column(i) for i in range(width)] + [pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
    return run


def count_tokens(docs: DataFrame, pieces, text="text", out="n_tokens", key="doc_id", split=True) -> DataFrame:
    """`docs` with the number of tokens of each whole text.

    `pieces` is a list of (piece, score), of the size of a vocabulary. With `split` (the
    way of tokenizers that cut at every blank first), pieces of several marks never match.
    """
    shared = docs.sparkSession.sparkContext.broadcast(list(pieces))
    made = T.StructType([T.StructField(out, T.LongType())])
    return map_column(spread_if_few(docs, key), made, lambda at, n: _counts(shared, split, at, n), text)
