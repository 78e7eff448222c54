"""Operator 12 - spelling variants by Bloom-guided neighbourhoods.

Words and their counts come from the whole texts. Two words are near if one
inserted, deleted or replaced code point turns one into the other. The vocabulary is
put into blocked Bloom filters, one shard a word length, which are broadcast; every
word's edits are generated and probed there, and only edits that a filter knows are
shuffled to an exact join with the vocabulary, which removes false positives.

Each near pair is generated once: deletions of a word (an insertion is the other
word's deletion; of equal neighbours only the first is deleted) and replacements of a
code point by a larger one that occurs in words of that length. Found pairs are then
mirrored. The hash of an edit follows from prefix sums of the word's hash, so no
edited string is built unless a filter knows it.

Bounds: a broadcast filter covers at most ``ROUND_WORDS`` words (``BITS`` bits each);
a larger vocabulary is probed in several rounds, shard by shard, a shard beyond that
in parts by hash. So nothing broadcast grows with the data, whatever its size.

Roots: a word's form occurs at least ``RATIO`` times as often as the word, so chains
are short; they are followed by pointer doubling on the words that have a form.

Defined results: null text has no words; null ids count as the empty text in
``<doc_id>:<run>``; repeated rows count again; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, map_arrow, mixed, stored, text_chunks

#: Fixed values of the contract: shortest word, least occurrences, damage by hash, how much more frequent a form is.
SHORTEST, LEAST, DAMAGE, RATIO = 7, 2, 31, 10
#: Parameters: filter bits a word, words of a broadcast filter, bits set in a block, longest length with a shard of
#: its own, probes of a vectorised step, distinct words held by a counting task.
BITS, ROUND_WORDS, SET_BITS, LONGEST, STEP, HELD = 32, 1 << 22, 5, 64, 1 << 20, 1 << 20
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def damaged_words(doc_id, text: str) -> Counter:
    """The document's runs after damage, with their numbers. Shorter runs cannot become words."""
    runs = Counter(_RUN.findall(text.encode().lower().decode()))
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), seed)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < SHORTEST:
                continue
        out[run] += n
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of all words, counted in each task before the shuffle."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")

    def run(it):
        held: Counter = Counter()
        for b, texts in text_chunks(it):
            for doc, t in zip(b.column("doc_id").to_pylist(), texts):
                for w, n in damaged_words(doc, t).items():
                    held[w] += n
            if len(held) > HELD:
                yield {"word": list(held), "n": list(held.values())}
                held = Counter()
        yield {"word": list(held), "n": list(held.values())}

    counts = map_arrow(rows, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST)


# ---------------------------------------------------------------- hashes and filters

def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in one array, and where each begins (and the end). All are below 256."""
    size = np.array([len(w) for w in words], np.int64)
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), np.concatenate(([0], np.cumsum(size)))


def powers(n: int) -> np.ndarray:
    p = np.full(n + 1, np.uint64(_BASE), np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def rolled(m: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Prefix sums (rows x length + 1) of code point times power, wrapping; the last column is the word's hash."""
    out = np.zeros((m.shape[0], m.shape[1] + 1), np.uint64)
    np.cumsum((m.astype(np.uint64) + np.uint64(1)) * p[None, :m.shape[1]], axis=1, out=out[:, 1:])
    return out


class Shards:
    """Which filter, block and bits a hash has. ``sizes``: words of each shard (length, the last for all longer ones)."""

    def __init__(self, sizes: dict[int, int], round_words: int = ROUND_WORDS):
        self.parts = {k: -(-n // round_words) for k, n in sizes.items()}
        self.blocks, self.rounds = {}, []
        used = round_words + 1
        for k in sorted(sizes):
            n = -(-sizes[k] // self.parts[k])
            # Parts of a shard differ by chance; a fuller one only has more false positives.
            self.blocks[k] = max(1, n * BITS // 64)
            for part in range(self.parts[k]):
                if used + n > round_words:
                    self.rounds.append({})
                    used = 0
                at = sum(self.blocks[x] for x, _ in self.rounds[-1])
                self.rounds[-1][k, part] = at
                used += n

    def words_of(self, i: int) -> int:
        return sum(self.blocks[k] for k, _ in self.rounds[i])

    def place(self, i: int, shard: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block in round ``i`` (-1: in another round) and bits of hashes that belong to a shard."""
        h = mixed(h)
        part = ((h & np.uint64(0xFFFF)) % np.uint64(self.parts[shard])).astype(np.int64)
        first = np.array([self.rounds[i].get((shard, p), -1) for p in range(self.parts[shard])])[part]
        block = ((h >> np.uint64(32)) * np.uint64(self.blocks[shard]) >> np.uint64(32)).astype(np.int64)
        g = mixed(h + np.uint64(_BASE))
        bits = np.zeros(len(h), np.uint64)
        for j in range(SET_BITS):
            bits |= np.uint64(1) << ((g >> np.uint64(6 * j)) & np.uint64(63))
        return np.where(first < 0, -1, first + block), bits


def _shard(length: int) -> int:
    return min(length, LONGEST)


def _matrices(words: list[str]):
    """(indices, code points as rows) of words of equal length, in steps of bounded size."""
    flat, begin = letters(words)
    size = np.diff(begin)
    for length in np.unique(size).tolist():
        at = np.flatnonzero(size == length)
        step = max(1, STEP // (length * length))
        for s in range(0, len(at), step):
            k = at[s:s + step]
            yield k, flat[begin[k][:, None] + np.arange(length)[None, :]]


def _filter(vocab: DataFrame, shards: Shards, i: int) -> np.ndarray:
    """The filter of round ``i``, put together from the blocks that tasks report."""

    def run(it):
        for b in it:
            words = b.column("word").to_pylist()
            for k, m in _matrices(words):
                shard = _shard(m.shape[1])
                if not any(x == shard for x, _ in shards.rounds[i]):
                    continue
                at, bits = shards.place(i, shard, rolled(m, powers(m.shape[1]))[:, -1])
                yield {"at": at[at >= 0], "bits": bits[at >= 0].view(np.int64)}

    rows = map_arrow(vocab.select("word"), run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(shards.words_of(i), np.uint64)  # bounded: ROUND_WORDS * BITS bits, and one shard's rounding
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


# ---------------------------------------------------------------- edits

def deletions(m: np.ndarray, p: np.ndarray, sums: np.ndarray):
    """(row, position, hash) of every distinct deletion."""
    first = np.ones(m.shape, bool)
    first[:, 1:] = m[:, 1:] != m[:, :-1]
    row, pos = np.nonzero(first)
    tail = sums[row, -1] - sums[row, pos + 1]
    return row, pos, sums[row, pos] + tail * np.uint64(_BACK)


def replacements(m: np.ndarray, p: np.ndarray, sums: np.ndarray, alphabet: np.ndarray):
    """(row, position, code point, hash) of every replacement by a larger code point, in bounded steps."""
    step = max(1, STEP // max(1, m.size))
    for s in range(0, len(alphabet), step):
        c = alphabet[s:s + step]
        row, pos, k = np.nonzero(m[:, :, None] < c[None, None, :])
        by = c[k].astype(np.uint64) - m[row, pos].astype(np.uint64)
        yield row, pos, c[k], sums[row, -1] + by * p[pos]


def _probe(shards: Shards, i: int, bloom, alphabets: dict[int, bytes]):
    """(edit, word, n) of the edits that the filter of round ``i`` knows."""

    def run(it):
        table = bloom.value
        here = {k for k, _ in shards.rounds[i]}

        def known(shard, h):
            at, bits = shards.place(i, shard, h)
            return np.flatnonzero((at >= 0) & ((table[at] & bits) == bits))

        for b in it:
            words, n = b.column("word").to_pylist(), b.column("n").to_numpy()
            edits, source = [], []
            for k, m in _matrices(words):
                length = m.shape[1]
                cut, own = _shard(length - 1), _shard(length)
                if cut not in here and own not in here:
                    continue
                p = powers(length)
                sums = rolled(m, p)
                if cut in here and length > SHORTEST:
                    row, pos, h = deletions(m, p, sums)
                    for x in known(cut, h).tolist():
                        w = words[k[row[x]]]
                        edits.append(w[:pos[x]] + w[pos[x] + 1:])
                        source.append(k[row[x]])
                if own in here:
                    for row, pos, c, h in replacements(m, p, sums, np.frombuffer(alphabets[own], np.uint8)):
                        for x in known(own, h).tolist():
                            w = words[k[row[x]]]
                            edits.append(w[:pos[x]] + chr(c[x]) + w[pos[x] + 1:])
                            source.append(k[row[x]])
                if len(edits) > 1 << 16:
                    yield {"edit": edits, "word": [words[x] for x in source], "n": n[source]}
                    edits, source = [], []
            if edits:
                yield {"edit": edits, "word": [words[x] for x in source], "n": n[source]}

    return run


def near_pairs(vocab: DataFrame, round_words: int = ROUND_WORDS) -> DataFrame:
    """(word, n, near, near_n) of every near pair, in both directions, from a stored vocabulary (word, n)."""
    spark = vocab.sparkSession
    shard = F.least(F.length("word"), F.lit(LONGEST))
    code = F.explode(F.array_distinct(F.split("word", "")))
    sizes = {r[0]: r[1] for r in vocab.groupBy(shard.alias("k")).count().collect()}  # at most LONGEST rows
    if not sizes:
        return vocab.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    seen = vocab.select(shard.alias("k"), code.alias("c")).where("c <> ''").distinct()  # at most 90 code points a shard
    alphabets: dict[int, bytes] = {}
    for k, chars in seen.groupBy("k").agg(F.sort_array(F.collect_set("c"))).collect():
        alphabets[k] = bytes(sorted("".join(chars).encode("latin-1")))
    shards = Shards(sizes, round_words)
    found = None
    for i in range(len(shards.rounds)):
        bloom = spark.sparkContext.broadcast(_filter(vocab, shards, i))
        hits = map_arrow(vocab, _probe(shards, i, bloom, alphabets), "edit string, word string, n long")
        found = hits if found is None else found.union(hits)
    v = vocab.select(F.col("word").alias("edit"), F.col("n").alias("edit_n"))

    def pair(*cols: str):
        return F.struct(*[F.col(c).alias(name) for c, name in zip(cols, ("word", "n", "near", "near_n"))])

    return found.join(v, "edit").select(F.inline(F.array(pair("word", "n", "edit", "edit_n"), pair("edit", "edit_n", "word", "n"))))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling on written tables."""
    cur = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        step = cur.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = stored(cur.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        moved = not nxt.where("moved").isEmpty()
        drop_stored(cur)
        cur = nxt.drop("moved")
        if not moved:
            return cur


def spelling_variants(docs: DataFrame, round_words: int = ROUND_WORDS) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n."""
    vocab = stored(vocabulary(docs), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near").alias("word")))
    near = near_pairs(vocab, round_words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.neg") >= RATIO * F.col("n")
    rows = vocab.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.neg")).alias("form_n"))
    rows = stored(rows, "variants")
    drop_stored(vocab)
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_query(docs: DataFrame) -> DataFrame:
    return spelling_variants(docs)
