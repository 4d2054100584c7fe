"""Byte-level BPE: encode texts to token ids and decode ids to bytes.

The text is cut by the tokenizer's split pattern; every match is encoded on its own. Within a match
a segment tree over the byte positions keeps, for every live position, the merge rank of the pair
that starts there. Its root is the leftmost pair of least rank; a merge changes three leaves, each
in a logarithmic number of steps, so a match of n bytes takes O(n log n).

Ids travel as packed little-endian unsigned 32-bit integers in a binary column, which is half the
work of an array column and the form training files use; ``unpack_ids`` turns them into an array.

Nulls count as empty text and give empty ids. Null ids decode to empty bytes; an id outside the
vocabulary fails the job, as decoding it would lose data.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import memos

#: Split pattern of the byte-level vocabularies (a fixed value of the public rank files).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_NONE = 1 << 40  # above every rank
_CACHED = 250_000  # entries of a memo's younger half
_LONGEST_CACHED = 64
_ABOVE = (1 << 31) - 1  # above every rank, in tables
_LONGEST_TABLED = 64  # bytes of a match that ``Together`` merges in a table

# A blank joined to further white space: there, cutting at blanks alone would change matches.
_AWKWARD = re.compile(r"\s \s|\s \Z")


def read_ranks(path: str) -> bytes:
    """The rank file's content, to be shipped with the tasks (under 1 MB)."""
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """Encoder and decoder of one rank file. Matches of at most ``scanned`` bytes are merged by scanning
    their few pairs for the least rank, which needs no tree; the ids are the same."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN, scanned: int = 0):
        import regex
        self.scanned = scanned
        self.ranks = {base64.b64decode(token): int(rank)
                      for token, rank in (line.split() for line in ranks.splitlines() if line)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pieces = _Memo(self._piece)
        self.words = _Memo(lambda word: self.encode_whole(" " + word))

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one match."""
        ranks, n = self.ranks, len(piece)
        if piece in ranks:
            return [ranks[piece]]
        if n <= self.scanned:
            return self._scan(piece)
        # Leaf i: rank of the pair that starts at i, times n, plus i. The least one is leftmost, too.
        rank_of, none = ranks.get, _NONE * n
        size = 1 << (n - 2).bit_length()
        tree = [none] * size
        tree += [rank_of(piece[i:i + 2], _NONE) * n + i for i in range(n - 1)]
        tree += [none] * (2 * size - len(tree))
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        end = list(range(1, n + 1))       # end of the token that starts at i
        before = list(range(-1, n))       # start of the token before the one that starts at i
        while (best := tree[1]) < none:
            i = best % n
            j = end[i]
            stop = end[i] = end[j]
            before[stop] = i
            low = high = size + i
            tree[low] = rank_of(piece[i:end[stop]], _NONE) * n + i if stop < n else none
            # The pair that started at j is gone; the last leaf may not exist, its token has none.
            if (top := size + j) < 2 * size:
                tree[top] = none
            else:
                top = high
            if i:
                h = before[i]
                low = size + h
                tree[low] = rank_of(piece[h:stop], _NONE) * n + h
            while low > 1:  # the three paths to the root, each node once
                low, high, top = low >> 1, high >> 1, top >> 1
                left, right = tree[2 * low], tree[2 * low + 1]
                tree[low] = left if left < right else right
                if high != low:
                    left, right = tree[2 * high], tree[2 * high + 1]
                    tree[high] = left if left < right else right
                if top != high:
                    left, right = tree[2 * top], tree[2 * top + 1]
                    tree[top] = left if left < right else right
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def _scan(self, piece: bytes) -> list[int]:
        rank_of = self.ranks.get
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [rank_of(piece[i:i + 2], _NONE) for i in range(len(piece) - 1)]
        while pairs and (best := min(pairs)) < _NONE:
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank_of(parts[i - 1] + parts[i], _NONE)
            if i < len(pairs):
                pairs[i] = rank_of(parts[i] + parts[i + 1], _NONE)
        return [self.ranks[part] for part in parts]

    def _piece(self, piece: str) -> bytes:
        packed = self.packed.get(raw := piece.encode())
        return packed or b"".join([rank.to_bytes(4, "little") for rank in self.merge(raw)])

    def encode_whole(self, text: str) -> bytes:
        """Packed ids, every match of the pattern in turn."""
        pieces = self.pieces
        return b"".join([pieces[piece] for piece in self.split(text)])

    @cached_property
    def together(self) -> Together:
        return Together(self)

    def encode(self, text: str | None) -> bytes:
        """Packed ids. A match never holds a blank except in front, so that text without runs of
        white space can be cut before every blank and its words be remembered."""
        if not text:
            return b""
        if _AWKWARD.search(text):
            return self.encode_whole(text)
        first, *rest = text.split(" ")
        words = self.words
        return self.encode_whole(first) + b"".join([words[word] for word in rest])

    def decode(self, packed: bytes | None) -> bytes:
        if not packed:
            return b""
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(packed, "<u4").tolist()])


class Together:
    """Encodes many texts at once. Their words are numbered, new words are cut by one search, and the
    matches in them are merged as rows of a table; ids are those of ``Codec.encode``."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.met: dict[str, bytes] = {}  # ids of a word with a blank in front
        ranks = codec.ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        made = sorted((ranks[token[:k]] << 32 | ranks[token[k:]], rank)
                      for token, rank in ranks.items() for k in range(1, len(token))
                      if token[:k] in ranks and token[k:] in ranks)
        self.pairs, made = np.array([*made, (1 << 62, _ABOVE)], np.int64).T.copy()
        self.made = made.astype(np.int32)
        # Ranks of all pairs of bytes: most pairs that are looked up are such.
        self.byte_pairs = self._made(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after the other, and every text's number of ids."""
        split = self.codec.split
        whole = [_AWKWARD.search(text) is not None for text in texts]
        parts = [(text, "", "") if awkward else text.partition(" ")
                 for text, awkward in zip(texts, whole, strict=True)]
        bare = [split(first) for first, _, _ in parts]
        rest = pc.split_pattern(pa.array([rest if blank else None for _, blank, rest in parts],
                                         pa.large_string()), " ")
        words = rest.flatten().dictionary_encode()
        known = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        n_words = rest.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        n_bare = np.fromiter(map(len, bare), np.int64, len(bare))

        if len(self.met) > _CACHED:
            self.met.clear()
        met = self.met
        fresh = [word for word in known if word not in met]
        fresh, matches, n_matches = self._cut(fresh)
        matches += chain.from_iterable(bare)
        number = pa.array(matches, pa.large_string()).dictionary_encode()
        ids, sizes = self._merged([m.encode() for m in number.dictionary.to_numpy(zero_copy_only=False)])
        number = number.indices.to_numpy()
        n_fresh = int(n_matches.sum())
        packed, n = _gathered(ids, sizes, number[:n_fresh])
        ends = 4 * np.cumsum(n)[np.cumsum(n_matches) - 1] if len(fresh) else np.empty(0, np.int64)
        raw = packed.astype("<u4").tobytes()
        met.update(zip(fresh, [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())], strict=True))

        # A text is the numbers of its first matches, then those of its words.
        of_word = [met[word] for word in known]
        table = np.concatenate([np.frombuffer(b"".join(of_word), "<u4").astype(np.int64), ids])
        sizes = np.concatenate([np.fromiter(map(len, of_word), np.int64, len(known)) // 4, sizes])
        start = np.cumsum(n_bare + n_words) - n_bare - n_words
        order = np.empty(int(n_bare.sum() + n_words.sum()), np.int64)
        order[_places(start, n_bare)] = number[n_fresh:] + len(known)
        order[_places(start + n_bare, n_words)] = words.indices.to_numpy()
        found, n = _gathered(table, sizes, order)
        before = np.concatenate([[0], np.cumsum(n)])
        return found, before[start + n_bare + n_words] - before[start]

    def _cut(self, words: list[str]) -> tuple[list[str], list[str], np.ndarray]:
        """Words, all matches in them with a blank before each word, and the number of these."""
        split = self.codec.split
        edged = [word for word in words if not word or word != word.strip()]
        apart = set(edged)
        plain = [word for word in words if word not in apart] if edged else words
        # Joined by blanks the plain ones have no runs of white space, so the search cuts at every blank.
        matches = split(" " + " ".join(plain)) if plain else []
        first = np.flatnonzero(np.array([m[0] == " " for m in matches], bool))
        more = [split(" " + word) for word in edged]
        n = np.concatenate([np.diff(np.append(first, len(matches))),
                            np.fromiter(map(len, more), np.int64, len(more))])
        return plain + edged, [*matches, *chain.from_iterable(more)], n.astype(np.int64)

    def _merged(self, matches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of matches, one after the other, and their numbers. Matches of as many tokens form a
        table: each of its rows makes one merge a step, or is done and leaves."""
        rank = self.codec.ranks.get
        whole = np.array([rank(match, -1) for match in matches], np.int64)
        size = np.array([*map(len, matches)], np.int64)
        done = [(np.flatnonzero(whole >= 0), whole[whole >= 0, None])]
        for k in np.flatnonzero((whole < 0) & (size > _LONGEST_TABLED)):
            done.append((np.array([k]), np.array([self.codec.merge(matches[k])], np.int64)))
        size[(whole >= 0) | (size > _LONGEST_TABLED)] = 0
        rows, ids, ranks = np.empty(0, np.int64), None, None
        for n in range(int(size.max(initial=0)), 1, -1):
            own = np.flatnonzero(size == n)
            if len(own):
                byte = np.frombuffer(b"".join([matches[k] for k in own]), np.uint8)
                new = self.byte_ids[byte].reshape(-1, n)
                byte = byte.reshape(-1, n)
                paired = self.byte_pairs[byte[:, :-1].astype(np.intp) << 8 | byte[:, 1:]]
                ids = np.concatenate([ids, new]) if len(rows) else new
                ranks = np.concatenate([ranks, paired]) if len(rows) else paired
                rows = np.concatenate([rows, own])
            if not len(rows):
                continue
            at = ranks.argmin(axis=1)  # the leftmost of least rank
            best = ranks[np.arange(len(rows)), at]
            going = best < _ABOVE
            done.append((rows[~going], ids[~going]))
            rows, ids, ranks, at, best = rows[going], ids[going], ranks[going], at[going], best[going]
            row = np.arange(len(rows))
            stays = np.ones(ids.shape, bool)
            stays[row, at + 1] = False
            ids[row, at] = best
            ids = ids[stays].reshape(len(rows), n - 1)
            ranks = ranks[stays[:, 1:]].reshape(len(rows), n - 2)
            for there, left in ((at > 0, at - 1), (at < n - 2, at)):
                i, j = row[there], left[there]
                ranks[i, j] = self._made(ids[i, j], ids[i, j + 1])
        if len(rows):
            done.append((rows, ids))
        sizes = np.zeros(len(matches), np.int64)
        for rows, ids in done:
            sizes[rows] = ids.shape[1]
        start = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int64)
        for rows, ids in done:
            out[start[rows, None] + np.arange(ids.shape[1])] = ids
        return out, sizes

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens (ids) make, above all ranks if none."""
        wanted = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.made[at], np.int32(_ABOVE))


def _places(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each range, n numbers long, one after the other."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _gathered(values: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of numbers ``at`` of values that lie one after the other, and their sizes."""
    n = sizes[at]
    return values[_places((np.cumsum(sizes) - sizes)[at], n)], n


class _Memo(dict):
    """Remembers a function of a short string. A full half becomes the older one, from which what
    is still in use comes back; what was in the older half before is forgotten."""

    def __init__(self, function):
        super().__init__()
        self.function, self.older = function, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= _LONGEST_CACHED:
            if len(self) >= _CACHED:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


_codecs: dict[tuple[int, str, int], Codec] = {}
memos.keep("bpe", _codecs.clear)


def codec_of(ranks: bytes, pattern: str = PATTERN, scanned: int = 0) -> Codec:
    """One codec per worker process and vocabulary."""
    memos.claim("bpe")
    key = (hash(ranks), pattern, scanned)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks, pattern, scanned)
    return _codecs[key]


def _packed_array(values: Iterator[bytes]) -> pa.Array:
    """A binary array, gathered in one buffer."""
    buffer, ends = bytearray(), [0]
    for value in values:
        buffer += value
        ends.append(len(buffer))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer(np.array(ends, np.int32)), pa.py_buffer(buffer)])


def encoder(spark: SparkSession, path: str, pattern: str = PATTERN):
    """A function from a text column to a binary column of packed ids."""
    ranks = spark.sparkContext.broadcast(read_ranks(path))

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(ranks.value, pattern)
        for batch in batches:
            yield _packed_array(codec.encode(x.as_py()) for x in batch)
    return encode


def decoder(spark: SparkSession, path: str):
    """A function from a binary column of packed ids to a binary column of the text's bytes."""
    ranks = spark.sparkContext.broadcast(read_ranks(path))

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(ranks.value)
        for batch in batches:
            yield _packed_array(codec.decode(x.as_py()) for x in batch)
    return decode


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids",
           pattern: str = PATTERN) -> DataFrame:
    """Add (or replace) the column ``ids``: packed ids of ``text``. Other columns are kept."""
    return df.withColumn(ids, encoder(df.sparkSession, path, pattern)(F.col(f"`{text}`")))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Add (or replace) the column ``to``: bytes that the packed ``ids`` stand for."""
    return df.withColumn(to, decoder(df.sparkSession, path)(F.col(f"`{ids}`")))


def id_count(ids: Column) -> Column:
    return F.expr("bigint(0)") + F.floor(F.octet_length(ids) / 4)


def unpack_ids(ids: Column) -> Column:
    """Packed ids as array<int> (ids are below 2^31)."""
    digits = F.hex(ids)
    return F.when(F.octet_length(ids) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor(F.octet_length(ids) / 4).cast("int") - 1),
                    lambda i: F.conv(F.concat(*[F.substring(digits, i * 8 + k, F.lit(2))
                                                for k in (7, 5, 3, 1)]), 16, 10).cast("int")))
