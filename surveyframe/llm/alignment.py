"""Operator 13 - alignment of two tokenizers over the same text.

Both tokenizers cut the same bytes; where tokens of both end at the same byte offset,
a group ends. Per piece of text, each side's cumulative ends become a dictionary from
end to index; the intersection of their keys, sorted, slices both id lists into groups,
and every A-B pair of a group is a link.

A text is taken apart at single spaces between characters that are no white space:
there the byte-level pattern always starts a new piece, and no sentence piece of the
vocabulary has a space after another character (checked when the tokenizers are
loaded), so both tokenizers cut there and a group ends there. Pieces repeat, so the
distinct ones of some megabytes of text are encoded and aligned in one go. A text with a
piece whose bytes do not come back is encoded whole.

Texts are encoded and aligned once: every document is stored with its digest and its
distinct pairs, each with the number of its links. How many documents hold a pair is
counted from that table, summed in every task before the shuffle. Then every document
looks its pairs up. The counts are broadcast in blocks of at most ``BLOCK_PAIRS`` pairs;
with more than one block each document's sums are added by a row id. So no broadcast
grows with the data, and a pair that most documents hold is never a join key.

Defined results: texts that are null, empty or whose bytes do not come back from both
tokenizers have no tokens: zeros and an empty digest. Every row is a document, also a
repeated one. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, map_arrow, stored, text_chunks

#: Parameters: pairs of a broadcast block, bytes of text aligned in one go.
BLOCK_PAIRS, CHUNK_TEXT = 1 << 21, 1 << 22
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"


def byte_letters() -> dict[str, int]:
    """The byte behind every letter of a byte-level vocabulary: printable bytes stand for themselves, others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, and the bytes of every id."""

    def __init__(self, json_file: str, model_file: str, ranks_file: str | None = None, pattern: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(json_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_file)
        letter = byte_letters()
        self.bytes_a = {i: bytes(letter[c] for c in t) if all(c in letter for c in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            p = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode())
        # Without such a piece no merge reaches over a space that follows another character.
        self.cuts = not any(_SPACE in self.b.id_to_piece(i).lstrip(_SPACE) for i in range(len(self.bytes_b)))

        self.sizes = max(self.bytes_a) + 1, len(self.bytes_b)
        self.len_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(self.sizes[0])], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        labels = [f"{i}{end}" for n, ends in zip(self.sizes, (",|", ",;")) for end in ends for i in range(n)]
        self.labels, self.widths = np.array(labels, object), np.array([len(x) for x in labels], np.int64)
        self.words = None
        if ranks_file:
            import base64

            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
            self.words = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def pieces(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuts else [text]

    def joins(self, piece: str) -> bool:
        """May the piece stand between others, a space before each? Both tokenizers then cut at these spaces."""
        return self.cuts and not piece[:1].isspace() and not piece[-1:].isspace() and _SPACE not in piece

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both tokenizers for each text behind a space; None where the bytes do not come back."""
        out = []
        for t in texts:
            a, b = self.a.encode(" " + t, add_special_tokens=False).ids, self.b.encode(t)
            raw = b" " + t.encode()
            same = b"".join([self.bytes_a[i] for i in a]) == raw == b"".join([self.bytes_b[i] for i in b])
            out.append((a, b) if same else None)
        return out

    def common_ends(self, a, b) -> tuple[np.ndarray, np.ndarray]:
        """How many A and B tokens lie before each byte offset where tokens of both end."""
        ends_a = dict(zip(np.cumsum(self.len_a[a]).tolist(), range(1, len(a) + 1)))
        ends_b = dict(zip(np.cumsum(self.len_b[b]).tolist(), range(1, len(b) + 1)))
        common = sorted(ends_a.keys() & ends_b.keys())
        return np.array([ends_a[e] for e in common], np.int64), np.array([ends_b[e] for e in common], np.int64)

    def together(self, pieces: list[str]):
        """Ids and group sizes of both sides and the piece of every group, for pieces encoded in one go; None where
        the bytes do not come back."""
        text = " ".join(pieces)
        a = self.words.encode_to_numpy(" " + text) if self.words else self.a.encode(" " + text, add_special_tokens=False).ids
        a, b = np.array(a, np.int64), np.array(self.b.encode(text), np.int64)
        raw = b" " + text.encode()
        if b"".join([self.bytes_a[i] for i in a.tolist()]) != raw or b"".join([self.bytes_b[i] for i in b.tolist()]) != raw:
            return None
        ia, ib = self.common_ends(a, b)
        ends = np.cumsum([len(p.encode()) + 1 for p in pieces])
        at = np.cumsum(self.len_a[a])[ia - 1]
        return a, b, np.diff(ia, prepend=0), np.diff(ib, prepend=0), np.searchsorted(ends, at)


class Chunk:
    """The aligned pieces of some texts, in flat arrays.

    ``place``/``doc``: piece and text of every occurrence; per piece ``n_a``, ``n_b``, ``n_groups``, ``n_links``;
    per link its ``pair`` (a << 32 | b) and ``owner`` piece; ``ok``: texts with tokens.
    """

    def __init__(self, tok: Pair, texts: list[str]):
        cut = [tok.pieces(t) if t else [] for t in texts]
        every = [p for c in cut for p in c]
        while True:
            self._align(tok, dict.fromkeys(every))
            bad = {p for p, k in self.at.items() if not self.fine[k]}
            again = [i for i, c in enumerate(cut) if bad and len(c) > 1 and not bad.isdisjoint(c)]
            if not again:
                break
            for i in again:  # a piece whose bytes do not come back: the text is encoded whole
                cut[i] = [texts[i]]
            every = [p for c in cut for p in c]
        size = np.array([len(c) for c in cut], np.int64)
        self.doc = np.repeat(np.arange(len(texts)), size)
        self.place = np.fromiter(map(self.at.__getitem__, every), np.int64, len(every))
        self.ok = np.zeros(len(texts), bool)
        self.ok[self.doc] = self.fine[self.place]

    def _align(self, tok: Pair, distinct):
        plain, other = [], []
        for p in distinct:
            (plain if tok.joins(p) else other).append(p)
        one = tok.together(plain) if plain else None
        if one is None:  # a piece among them changes in a tokenizer: each on its own
            plain, other = [], plain + other
        pieces = plain + other
        self.at = {p: i for i, p in enumerate(pieces)}
        self.fine = np.ones(len(pieces), bool)
        a, b, size_a, size_b, owner = ([x] for x in one) if one else ([], [], [], [], [])
        for i, got in enumerate(tok.encode(other), len(plain)):
            if got is None:
                self.fine[i] = False
                continue
            ia, ib = tok.common_ends(*got)
            a.append(np.array(got[0], np.int64))
            b.append(np.array(got[1], np.int64))
            size_a.append(np.diff(ia, prepend=0))
            size_b.append(np.diff(ib, prepend=0))
            owner.append(np.full(len(ia), i))
        none = np.zeros(0, np.int64)
        self.a, self.b, self.size_a, self.size_b, self.group_owner = (
            np.concatenate(x).astype(np.int64) if x else none for x in (a, b, size_a, size_b, owner))
        n = len(pieces)
        links = self.size_a * self.size_b
        self.n_a, self.n_b, self.n_links = (
            np.bincount(self.group_owner, weights=w, minlength=n).astype(np.int64) for w in (self.size_a, self.size_b, links))
        self.n_groups = np.bincount(self.group_owner, minlength=n)
        # Every A id of a slice with every B id of it.
        group = np.repeat(np.arange(len(links)), links)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        first_a, first_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        self.pair = (self.a[first_a[group] + nth // self.size_b[group]] << 32) | self.b[first_b[group] + nth % self.size_b[group]]
        self.owner = self.group_owner[group]

    def per_text(self, by_piece: np.ndarray, texts: int) -> np.ndarray:
        return np.bincount(self.doc, weights=by_piece[self.place], minlength=texts).astype(np.int64)

    def pairs(self, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct pairs of each text in order, how many links are of each, and where each text's pairs begin
        (with the end of the last one's)."""
        pair, code = np.unique(self.pair, return_inverse=True)
        pieces, kinds = max(1, len(self.at)), max(1, len(pair))
        used, often = np.unique(self.doc * pieces + self.place, return_counts=True)
        doc, piece = used // pieces, used % pieces
        begin = np.searchsorted(self.owner, np.arange(len(self.at) + 1))
        n = np.diff(begin)[piece]
        at = np.arange(int(n.sum())) + np.repeat(begin[piece] - (np.cumsum(n) - n), n)
        key = np.repeat(doc, n) * kinds + code[at]
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.add.reduceat(np.repeat(often, n)[order], first) if len(first) else np.zeros(0, np.int64)
        key = key[first]
        return pair[key % kinds], times, np.searchsorted(key, np.arange(texts + 1) * kinds)

    def group_texts(self, tok: Pair) -> list[str]:
        """Per piece its groups as text, each followed by a semicolon."""
        na, nb = tok.sizes
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[np.cumsum(self.size_a) - 1] = True
        last_b[np.cumsum(self.size_b) - 1] = True
        both = self.size_a + self.size_b
        begin = np.cumsum(both) - both
        out = np.empty(len(self.a) + len(self.b), np.int64)
        ga, gb = np.repeat(np.arange(len(both)), self.size_a), np.repeat(np.arange(len(both)), self.size_b)
        nth_a = np.arange(len(ga)) - (np.cumsum(self.size_a) - self.size_a)[ga]
        nth_b = np.arange(len(gb)) - (np.cumsum(self.size_b) - self.size_b)[gb]
        out[begin[ga] + nth_a] = self.a + na * last_a
        out[begin[gb] + self.size_a[gb] + nth_b] = 2 * na + self.b + nb * last_b
        words = "".join(tok.labels[out].tolist())
        width = np.bincount(np.repeat(self.group_owner, both), weights=tok.widths[out], minlength=len(self.at)).astype(np.int64)
        ends = np.cumsum(width)
        return [words[s:e] for s, e in zip((ends - width).tolist(), ends.tolist())]


SCALARS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(rows: DataFrame, files: tuple) -> DataFrame:
    """Per document its counts and digest, its distinct pairs and the links of each."""

    def run(it):
        tok = Pair(*files)
        for b, texts in text_chunks(it, "text", CHUNK_TEXT):
            c = Chunk(tok, texts)
            out = {x: c.per_text(getattr(c, x), len(texts)) for x in SCALARS}
            strings, ends = c.group_texts(tok), np.searchsorted(c.doc, np.arange(len(texts) + 1)).tolist()
            place = c.place.tolist()
            out["groups_sha256"] = [hashlib.sha256("".join([strings[k] for k in place[s:e]])[:-1].encode()).hexdigest() if ok else ""
                                    for ok, s, e in zip(c.ok.tolist(), ends, ends[1:])]
            pair, times, begin = c.pairs(len(texts))
            begin = pa.array(begin, pa.int32())
            yield {"doc_id": b.column("doc_id"), "pairs": pa.ListArray.from_arrays(begin, pa.array(pair, pa.int64())),
                   "times": pa.ListArray.from_arrays(begin, pa.array(times, pa.int64()))} | out

    return map_arrow(rows, run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                "pairs array<long>, times array<long>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """The stored (pair, n, best): documents that hold the id pair linked, and whether no pair of its A id has more."""
    n = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    a = F.shiftright("pair", 32)
    most = n.groupBy(a.alias("a")).agg(F.max("n").alias("most"))  # at most as many rows as the vocabulary has ids
    out = stored(n.join(F.broadcast(most), a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    drop_stored(n)
    return out


def _looked_up(aligned: DataFrame, keep: str, block) -> DataFrame:
    """The columns ``keep`` of every document and its sums over the pairs of one block."""
    names = [c.split()[0] for c in keep.split(", ")]

    def run(it):
        pair, n, best = block.value
        for batch in it:
            for s in range(0, batch.num_rows, 1024):
                b = batch.slice(s, 1024)
                mine, times = (b.column(c).flatten().to_numpy() for c in ("pairs", "times"))
                ends = np.cumsum(b.column("pairs").value_lengths().to_numpy())
                at = np.minimum(np.searchsorted(pair, mine), len(pair) - 1)
                links = np.where(pair[at] == mine, times, 0)
                out = {c: b.column(c) for c in names}
                for c, weight in (("n_best", best), ("count_sum", n)):
                    total = np.concatenate(([0], np.cumsum(links * weight[at])))
                    out[c] = np.diff(total[ends], prepend=0)
                yield out

    return map_arrow(aligned.select(*names, "pairs", "times"), run, f"{keep}, n_best long, count_sum long")


def align(docs: DataFrame, json_file: str, model_file: str, block_pairs: int = BLOCK_PAIRS, ranks_file: str | None = None,
          pattern: str | None = None) -> DataFrame:
    """Per document: doc_id, tokens of both sides, groups, links, links of the best pairs, sum of counts, digest.

    ``ranks_file`` and ``pattern``: the vocabulary of ``json_file`` as ranks, which encodes the same faster."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = _aligned(rows, (json_file, model_file, ranks_file, pattern))
    aligned = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = pair_counts(aligned)
    blocks = max(1, -(-counts.count() // block_pairs))

    def block(i: int):
        # The pairs of a block are those with one remainder of their hash, about block_pairs of them.
        t = counts.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == i).toArrow()
        order = np.argsort(t.column("pair").to_numpy())
        return spark.sparkContext.broadcast(tuple(t.column(c).to_numpy()[order] for c in ("pair", "n", "best")))

    scalars = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    if blocks == 1:
        out = _looked_up(aligned, scalars, block(0))
    else:
        parts = None
        for i in range(blocks):
            sent = block(i)
            part = stored(_looked_up(aligned, "row long", sent), "aligned-block")
            sent.unpersist()
            parts = part if parts is None else parts.union(part)
        total = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        out = aligned.drop("pairs", "times").join(total, "row").drop("row")
    drop_stored(counts)
    return out


def op13_query(docs: DataFrame) -> DataFrame:
    import public_tokenizers as P

    return align(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), ranks_file=P.path("byte_bpe_50k.tiktoken"), pattern=P.PATTERN)
