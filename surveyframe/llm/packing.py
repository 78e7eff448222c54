"""Operator 5 - best-fit packing with large-item matching.

Pieces longer than a third of the capacity share a bin with at most one other
such piece: going down by length, each takes the longest piece that still fits
beside it. Shorter pieces, longest first, then go to the tightest gap that holds
them, and open new bins only when no gap does.

The plan needs only the number of pieces of each length, so it is made on a
table of at most ``capacity`` rows, whatever the corpus holds. It says, for each
length, which range of ranks goes to which bins at which place. Pieces get their
rank within their length from counts per (length, bucket) and a window per
(length, bucket); the bucket is a hash of the piece, so a length that a third of
the pieces share is spread over all buckets.

Defined results: null text is empty, that is one piece of one end token; a
document longer than the capacity is cut into full pieces, the first may be
shorter; repeated rows are packed like any other.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Words, map_arrow, mixed, stored, text_chunks

CAPACITY, END_ID = 2048, 0
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Pieces of one (length, bucket) on average, which sets the number of buckets.
BUCKET_ROWS = 1 << 18
#: Bytes of text whose words are made distinct together.
CHUNK = 1 << 21
#: A space next to other white space (or at an end), where splitting could change the tokens.
_UNSAFE = re.compile(r" [\s\x1c-\x1f]|[\s\x1c-\x1f] |^ | $")
#: First bytes of the UTF-8 forms of white space beyond ASCII: fixed values.
_WIDE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80"]


def splits_at_spaces(texts: list[str]) -> list[bool]:
    """Whether every space of a text stands alone between other characters."""
    raw = "x".join(texts).encode()
    if any(x in raw for x in _WIDE):
        return [not _UNSAFE.search(t) for t in texts]
    buf = np.frombuffer(raw, np.uint8)
    space = buf == 32
    white = space | ((buf >= 9) & (buf <= 13)) | ((buf >= 28) & (buf <= 31))
    bad = np.flatnonzero((space[:-1] & white[1:]) | (white[:-1] & space[1:]))
    ends = np.cumsum([len(t.encode()) + 1 for t in texts])
    hit = np.zeros(len(texts) + 1, bool)
    hit[np.searchsorted(ends, bad, "right")] = True
    return [not h and t[:1] != " " and t[-1:] != " " for h, t in zip(hit.tolist(), texts)]


class Encoder:
    """Token ids of whole texts, word by word.

    The tokenizer never joins a word with the space and word after it, so where the
    spaces of a text stand alone, its ids are those of its first word and of every
    later word with the space before it. The distinct words of a chunk of texts are
    encoded in one go, by the same vocabulary as ranks; the lengths of the tokens
    tell where each word ends. Other texts, and texts that hold an added token of the
    tokenizer such as ``<|endoftext|>`` (it becomes its id), are encoded whole.
    """

    def __init__(self, path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self._bytes[i] = len(token)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._tok.encode(text, add_special_tokens=False).ids, "<u4")

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        plain = [bool(t) and p and not any(a in t for a in self._added) for t, p in zip(texts, splits_at_spaces(texts))]
        found = iter(self._by_words([t for t, p in zip(texts, plain) if p]))
        return [next(found) if p else self.whole(t) if t else np.zeros(0, "<u4") for t, p in zip(texts, plain)]

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        w = Words(texts, only_spaces=True)
        h = w.hashes()
        first = w.first[:-1]  # a text's first word has no space before it
        later = np.ones(len(h), bool)
        later[first] = False
        _, at, inverse = np.unique(h[later], return_index=True, return_inverse=True)
        start, end = w.start[later][at].tolist(), w.end[later][at].tolist()
        pieces = [w.data[s - 1:e] for s, e in zip(start, end)]
        flat = self._words.encode_to_numpy(b"".join(pieces).decode()).astype("<u4") if pieces else np.zeros(0, "<u4")
        ends = np.searchsorted(np.cumsum(self._bytes[flat]), np.cumsum([len(p) for p in pieces]), "left") + 1
        lone = [self._words.encode_ordinary(w.data[s:e].decode()) for s, e in zip(w.start[first].tolist(), w.end[first].tolist())]
        own = np.fromiter(chain.from_iterable(lone), "<u4")
        size = np.concatenate((np.diff(np.concatenate(([0], ends))), np.array([len(x) for x in lone], np.int64))).astype(np.int64)
        pool = np.concatenate((flat, own))
        row = np.empty(len(h), np.int64)
        row[later], row[first] = inverse, len(pieces) + np.arange(len(first))
        begin = np.cumsum(size) - size
        n = size[row]
        offset = np.cumsum(n) - n
        out = pool[np.arange(int(n.sum())) + np.repeat(begin[row] - offset, n)]
        cuts = np.append(offset, len(out))[w.first]
        return [out[s:e] for s, e in zip(cuts[:-1], cuts[1:])]


def tokenized_pieces(docs: DataFrame, tokenizer: tuple[str, str, str], capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of every document.

    ``tokenizer``: path of the tokenizer, path of its ranks, pattern that splits words.
    """

    def run(it):
        enc = Encoder(*tokenizer)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
        for b, texts in text_chunks(it, "text", CHUNK):
            out = {k: [] for k in names}
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), enc(texts)):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                head = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(head, len(ids) + 1, capacity)]
                for k, (s, e) in enumerate(zip(cuts, cuts[1:])):
                    row = (doc_id, k, s, e - s, zlib.crc32(ids[s:e].tobytes()), *[ids[s:e]] * keep_ids)
                    for c, v in zip(names, row):
                        out[c].append(v)
            yield out

    return map_arrow(docs.select("doc_id", "text"), run,
                     "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, number, first bin, offset)`` that place every piece.

    ``counts``: pieces per length. Bins with the same contents are one group
    (first bin, number of bins), so the work depends on the lengths, not on the
    number of pieces.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    used: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> groups of bins
    bins = 0

    def place(length: int, n: int, first_bin: int, free: int):
        runs.append((length, used[length], n, first_bin, capacity - free))
        used[length] += n

    large = {x: n for x, n in counts.items() if 3 * x > capacity and n}
    for x in sorted(large, reverse=True):
        while large.get(x):
            partner = max((y for y, n in large.items() if n and y <= capacity - x), default=None)
            if partner is None:
                n = large.pop(x)
                place(x, n, bins, capacity)
                gaps[capacity - x].append((bins, n))
            else:
                n = min(large[x], large[partner]) if partner != x else large[x] // 2
                if n == 0:  # one piece is left that would only fit beside another of its length
                    other = max((y for y, m in large.items() if m and y < x and y <= capacity - x), default=None)
                    n, partner = 1, other
                place(x, n, bins, capacity)
                large[x] -= n
                free = capacity - x
                if partner is not None:
                    place(partner, n, bins, free)
                    large[partner] -= n
                    free -= partner
                gaps[free].append((bins, n))
            bins += n
    for x in sorted((x for x, n in counts.items() if 3 * x <= capacity and n), reverse=True):
        left = counts[x]
        for free in range(x, capacity + 1):
            while left and gaps.get(free):
                first, n = gaps[free].pop()
                fit = free // x  # the tightest gap is filled until it is too small
                whole = min(n, left // fit)
                if whole:
                    for k in range(fit):
                        place(x, whole, first, free - k * x)
                    left -= whole * fit
                    gaps[free - fit * x].append((first, whole))
                    if n > whole:
                        gaps[free].append((first + whole, n - whole))
                else:
                    for k in range(left):
                        place(x, 1, first, free - k * x)
                    gaps[free - left * x].append((first, 1))
                    left = 0
                    if n > 1:
                        gaps[free].append((first + 1, n - 1))
        if left:
            fit = capacity // x
            whole, rest = divmod(left, fit)
            if whole:
                for k in range(fit):
                    place(x, whole, bins, capacity - k * x)
                gaps[capacity - fit * x].append((bins, whole))
                bins += whole
            if rest:
                for k in range(rest):
                    place(x, 1, bins, capacity - k * x)
                gaps[capacity - rest * x].append((bins, 1))
                bins += 1
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (a stored table with ``length`` <= capacity)."""
    spark = pieces.sparkSession
    total = pieces.count()
    n_buckets = max(1, total // BUCKET_ROWS + 1) * 4
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_buckets)))
    sizes = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    by_length = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (keyed.withColumn("r", F.row_number().over(order) - 1).join(base, ["length", "bucket"])
              .withColumn("rank", F.col("r") + F.col("base")).drop("r", "base", "bucket"))
    runs = plan_bins(by_length, capacity)
    per_length = defaultdict(list)
    for length, rank, n, first, offset in runs:
        per_length[length].append((rank, first, offset))
    # One row per length at most: the plan's size follows the capacity, not the data.
    table = spark.createDataFrame(
        [(k, [x[0] for x in v], [x[1] for x in v], [x[2] for x in v]) for k, v in per_length.items()],
        "length long, ranks array<long>, firsts array<long>, offsets array<long>")
    joined = ranked.join(F.broadcast(table), "length")
    names = list(ranked.columns)

    def run(it):
        for b in it:
            if not b.num_rows:
                continue
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                ranks, firsts, offsets = (np.array(b.column(c)[int(at[0])].as_py(), np.int64) for c in ("ranks", "firsts", "offsets"))
                k = np.searchsorted(ranks, rank[at], "right") - 1
                seq[at], off[at] = firsts[k] + rank[at] - ranks[k], offsets[k]
            yield {c: b.column(c) for c in names if c != "rank"} | {"sequence_id": seq, "offset": off}

    types = dict(pieces.dtypes)
    cols = [c for c in names if c != "rank"]
    return map_arrow(joined, run, ", ".join(f"`{c}` {types[c]}" for c in cols) + ", sequence_id long, offset long")


def default_tokenizer() -> tuple[str, str, str]:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def pack_documents(docs: DataFrame, tokenizer: tuple[str, str, str] | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack whole documents; one row per piece."""
    pieces = stored(tokenized_pieces(docs, tokenizer or default_tokenizer(), capacity), "pieces")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: their pieces in order, and how many tokens they hold (at most one capacity each)."""
    return packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length"))).alias("pieces"),
        F.sum("length").alias("tokens"))


def op5_query(docs: DataFrame) -> DataFrame:
    return pack_documents(docs)
