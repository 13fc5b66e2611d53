"""Byte-level BPE by replaying merges over the distinct words of a block of texts.

A block's texts are cut into words by the pattern, and each word not met before is
laid out as byte tokens in one long row of positions. An inverted index leads from a
merge (by its rank) to the positions where it applies. Ranks are replayed from a heap,
lowest first; a merge changes its neighbours' pairs only, and these enter the index
under their own ranks. A merge can make a pair of lower rank than its own: the rest of
that word's places then wait until the lower rank is done, so that each word sees its
merges in just the order of the one-word rule (lowest rank first, leftmost first).

Encoding and decoding are one pass over the scan: no shuffle, no word leaves its task.
Memory is bounded by the block (`BLOCK_CHARS`) and the longest text.

Defined cases: a null text counts as empty; an empty text has no tokens; special tokens
are ordinary text; repeated rows get a result each; other columns pass through (result
columns replace columns of the same names); an empty table gives an empty table.
"""

import base64
import gc
import hashlib
import heapq
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docweave.llm.arrow import map_column
from docweave.session import spread_if_few

#: Characters of texts taken at once; pieces (and as many pairs) remembered between blocks.
BLOCK_CHARS = 4_000_000
KNOWN_WORDS = 250_000
#: From so many places on, a merge is applied to all of them together.
MANY = 32


def read_ranks(path):
    """Bytes of a token -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class State:
    """Per place: token, next and previous place of the word, rank of the pair that
    starts here, word. `whole` are the same arrays for numpy."""

    def __init__(self, *parts):
        self.parts = parts
        self.whole = [np.frombuffer(part, dtype=np.int64) for part in parts]


class Replay:
    """Encodes many words at once with one set of ranks."""

    def __init__(self, ranks, known_pairs=KNOWN_WORDS):
        self.ranks, self.known_pairs = ranks, known_pairs
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = np.full((256, 256), -1, dtype=np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                pairs[token[0], token[1]] = rank
        self.byte_pairs = pairs.ravel()
        self.pair_rank = {}

    def _rank(self, a, b):
        """Rank of the token that a and b make, or -1; remembered."""
        rank = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1)
        if len(self.pair_rank) > self.known_pairs:
            self.pair_rank.clear()
        self.pair_rank[a << 32 | b] = rank
        return rank

    def _ranks(self, keys):
        """Ranks of pairs given as left << 32 | right; negative keys are no pairs."""
        known, out = self.pair_rank.get, []
        for key in keys.tolist():
            rank = -1 if key < 0 else known(key)
            out.append(self._rank(key >> 32, key & 0xFFFFFFFF) if rank is None else rank)
        return np.array(out, dtype=np.int64)

    def _merge_many(self, state, rank, here):
        """Applies one merge at many places together: the new pairs as (rank, places).

        None, with nothing changed, if places overlap or a pair of lower rank arises;
        then order matters and they are taken one by one.
        """
        token, follow, before, pair_at, _ = state.whole
        at = np.array(here, dtype=np.int64)
        at.sort()
        good = pair_at[at] == rank
        good[1:] &= at[1:] != at[:-1]
        at = at[good]
        if not len(at):
            return []
        second = follow[at]
        if (at[1:] == second[:-1]).any():
            return None
        third, none = follow[second], len(token) - 1
        # token[none] is -1, which makes a negative key: no pair.
        old, beside = token[at], token[third]
        token[at] = rank
        after = token[third]
        right = self._ranks(rank << 32 | after)
        changed = after != beside
        lowest = self._ranks(rank << 32 | beside[changed]) if changed.any() else right
        held = before[third]
        before[third] = at
        first = before[at]
        left = self._ranks(np.where(first == none, -1, token[first] << 32 | rank))
        for found in (right, left, lowest):
            if ((found >= 0) & (found < rank)).any():
                before[third] = held
                token[at] = old
                return None
        follow[at] = third
        pair_at[second] = -1
        pair_at[at] = right
        pair_at[first] = left
        pair_at[none] = -1
        ranks, places = np.concatenate([right, left]), np.concatenate([at, first])
        some = ranks >= 0
        ranks, places = ranks[some], places[some]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order].tolist()
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(places)]
        return [(int(ranks[i]), places[i:j]) for i, j in zip(cuts, cuts[1:], strict=False) if i < j]

    def encode(self, words):
        """Ids of each word, given as bytes. A word that is a token is that token."""
        out = [None] * len(words)
        open_ = []
        for i, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is None and word:
                open_.append(i)
            else:
                out[i] = [rank] if word else []
        if open_:
            for i, ids in zip(open_, self._replay([words[i] for i in open_]), strict=True):
                out[i] = ids
        return out

    def _replay(self, words):
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        n = len(raw)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        last = np.zeros(n, dtype=bool)
        last[ends - 1] = True
        # First layout of the index, from pairs of bytes.
        first = self.byte_pairs[raw[:-1].astype(np.int64) * 256 + raw[1:]]
        first[last[:-1]] = -1
        places = np.flatnonzero(first >= 0)
        order = np.argsort(first[places], kind="stable")
        places = places[order]
        found, cuts = np.unique(first[places], return_index=True)
        index, cuts, flat = {}, [*cuts.tolist(), len(places)], places.tolist()
        for at, rank in enumerate(found.tolist()):
            index[rank] = flat[cuts[at]:cuts[at + 1]]
        heap = list(index)
        heapq.heapify(heap)

        # Arrays that both loops read: entry by entry, and as a whole. Place n is none.
        follow = np.arange(1, n + 2)
        follow[ends - 1] = n
        before = np.arange(-1, n)
        before[ends - lengths] = n
        word_of = np.repeat(np.arange(len(words)), lengths)
        state = State(*[array("q", x.astype(np.int64).tobytes()) for x in (
            np.append(self.byte_rank[raw], -1), follow, before, np.append(first, [-1, -1]), word_of)])
        token, follow, before, pair_at, word_of = state.parts
        pair_rank, rank_of, push = self.pair_rank, self._rank, heapq.heappush
        # What only the layout needs would take as much again as the state.
        del raw, last, first, places, order, flat

        while heap:
            rank = heapq.heappop(heap)
            here = index.pop(rank)
            if len(here) >= MANY:
                made = self._merge_many(state, rank, here)
                if made is not None:
                    for new, places in made:
                        if new in index:
                            index[new] += places
                        else:
                            index[new] = places
                            push(heap, new)
                    continue
            waits, later = -1, []
            left_half = rank << 32
            for i in sorted(here):
                if pair_at[i] != rank:
                    continue
                if waits == word_of[i]:
                    later.append(i)
                    continue
                j = follow[i]
                k = follow[j]
                token[i] = rank
                follow[i] = k
                pair_at[j] = pair_at[i] = -1
                if k < n:
                    before[k] = i
                    b = token[k]
                    new = pair_rank.get(left_half | b)
                    if new is None:
                        new = rank_of(rank, b)
                    if new >= 0:
                        pair_at[i] = new
                        held = index.get(new)
                        if held is None:
                            index[new] = [i]
                            push(heap, new)
                        else:
                            held.append(i)
                        if new < rank:
                            waits = word_of[i]
                h = before[i]
                if h < n:
                    a = token[h]
                    new = pair_rank.get(a << 32 | rank)
                    if new is None:
                        new = rank_of(a, rank)
                    pair_at[h] = new
                    if new >= 0:
                        held = index.get(new)
                        if held is None:
                            index[new] = [h]
                            push(heap, new)
                        else:
                            held.append(h)
                        if new < rank:
                            waits = word_of[i]
            if later:
                index[rank] = later
                push(heap, rank)

        out = []
        for start in (ends - lengths).tolist():
            ids, i = [], start
            while i < n:
                ids.append(token[i])
                i = follow[i]
            out.append(ids)
        return out


class Coder:
    """Codes texts with the pieces met so far; kept by a task.

    A piece is what stands between single blanks of a line, with the blank before it:
    the pattern cannot match across its ends. Texts with other blanks are cut by the
    pattern as a whole. Words of the pattern are pieces too. The ids of a piece are
    kept as packed numbers.
    """

    def __init__(self, ranks, pattern, known_words=KNOWN_WORDS, block_chars=BLOCK_CHARS):
        import regex

        self.replay = Replay(ranks, known_words)
        self.cut = regex.compile(pattern).findall
        self.known_words, self.block_chars = known_words, block_chars
        self.kind = "H" if max(ranks.values()) < 1 << 16 else "I"
        self.pieces, self.longest = {}, 0
        self.shown = {rank: str(rank) for rank in ranks.values()}

    @staticmethod
    def _pieces(text):
        """Pieces of a text; None if it has blanks other than single ones."""
        out = []
        for line in text.split("\n"):
            parts = line.split(" ")
            if not line or parts != line.split():
                return None
            if out:
                out.append("\n")
            out.append(parts[0])
            out += [" " + part for part in parts[1:]]
        return out

    def ids(self, texts):
        """The ids of each text as an array (null: empty)."""
        block, new, chars = [], {}, 0
        for text in texts:
            pieces = (self._pieces(text) or [text]) if text else []
            chars += 0 if text is None else len(text)
            new.update(dict.fromkeys(set(pieces).difference(self.pieces)))
            block.append(pieces)
            if chars > self.block_chars:
                yield from self._flush(block, new)
                block, new, chars = [], {}, 0
        yield from self._flush(block, new)

    def _flush(self, block, new):
        # A piece of letters is one word; isalpha is the pattern's class of letters.
        known = self.pieces
        cut = {piece: self.cut(piece) for piece in new if not piece.lstrip(" ").isalpha()}
        fresh = dict.fromkeys(piece for piece in new if piece not in cut)
        fresh.update((word, None) for words in cut.values() for word in words if word not in known)
        fresh = list(fresh)
        for word, ids in zip(fresh, self.replay.encode([word.encode("utf-8") for word in fresh]), strict=True):
            known[word] = array(self.kind, ids).tobytes()
        for piece, words in cut.items():
            known[piece] = b"".join(map(known.__getitem__, words))
        self.longest = max(map(len, new), default=self.longest)
        for pieces in block:
            ids = array(self.kind)
            ids.frombytes(b"".join(map(known.__getitem__, pieces)))
            yield ids
        if len(known) > self.known_words or self.longest > self.block_chars:
            self.pieces, self.longest = {}, 0

    def encode(self, texts):
        """Lists of ids, text by text (null: empty)."""
        return (ids.tolist() for ids in self.ids(texts))

    def decode(self, ids):
        return b"".join(map(self.replay.bytes_of.__getitem__, ids))

    def digests(self, texts):
        """Number of ids, SHA-256 of the ids as text, SHA-256 of the bytes decoded."""
        for ids in self.ids(texts):
            shown = ",".join(map(self.shown.__getitem__, ids))
            yield (len(ids), hashlib.sha256(shown.encode()).hexdigest(),
                   hashlib.sha256(self.decode(ids)).hexdigest())


def _digests(ranks_file, pattern, limits, position, width):
    """Map function: Arrow batches with three result columns added."""
    def run(batches):
        # No reference cycles arise here, and looking for them among the remembered
        # pieces would take longer than the work.
        gc.disable()
        coder = Coder(dict(ranks_file.value), pattern, *limits)
        for batch in batches:
            found = list(coder.digests(value.as_py() for value in batch.column(position)))
            n_tokens, ids_sha, bytes_sha = zip(*found, strict=True) if found else ((), (), ())
            arrays = [batch.column(i) for i in range(width)]
            arrays += [pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(bytes_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
    return run


def _ids(ranks_file, pattern, position, width):
    def run(batches):
        coder = Coder(dict(ranks_file.value), pattern)
        for batch in batches:
            texts = (value.as_py() for value in batch.column(position))
            arrays = [batch.column(i) for i in range(width)]
            arrays.append(pa.array(list(coder.encode(texts)), pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
    return run


def _decoded(ranks_file, position, width):
    def run(batches):
        bytes_of = {rank: token for token, rank in ranks_file.value}
        for batch in batches:
            texts = [None if ids is None else b"".join(map(bytes_of.__getitem__, ids))
                     for ids in batch.column(position).to_pylist()]
            arrays = [batch.column(i) for i in range(width)] + [pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[str(i) for i in range(len(arrays))])
    return run


def _shared_ranks(docs, path):
    # Bounded by the vocabulary, about a megabyte.
    return docs.sparkSession.sparkContext.broadcast(list(read_ranks(path).items()))


def encode(docs: DataFrame, path, pattern, text="text", ids="ids") -> DataFrame:
    """`docs` with the token ids of each whole text as array<int>."""
    ranks = _shared_ranks(docs, path)
    made = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return map_column(docs, made, lambda at, n: _ids(ranks, pattern, at, n), text)


def decode(docs: DataFrame, path, ids="ids", out="decoded") -> DataFrame:
    """`docs` with the bytes that the ids stand for."""
    ranks = _shared_ranks(docs, path)
    made = T.StructType([T.StructField(out, T.BinaryType())])
    return map_column(docs, made, lambda at, n: _decoded(ranks, at, n), ids)


def token_digests(docs: DataFrame, path, pattern, text="text", key="doc_id", known_words=KNOWN_WORDS,
                  block_chars=BLOCK_CHARS, keep_text=True) -> DataFrame:
    """`docs` with n_tokens, ids_sha256 (of the decimal ids, joined by commas) and
    decoded_sha256 (of the bytes decoded from the ids): both passes in one task, as ids
    need not leave it. `known_words` and `block_chars` bound a task's memory, not the
    result. Without `keep_text` the texts do not come back from the tasks' Python, which
    saves a copy of each batch on either side."""
    ranks = _shared_ranks(docs, path)
    made = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                         T.StructField("decoded_sha256", T.StringType())])
    return map_column(spread_if_few(docs, key), made, lambda at, n: _digests(ranks, pattern, (known_words, block_chars), at, n), text, keep_text)
