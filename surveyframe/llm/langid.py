"""Operator 6 - language identification by string kernels.

Blended-spectrum presence kernel: two texts are as similar as the number of
character n-grams (n = 1..3) that occur in both, normalised by their own
numbers. Nystroem landmarks map a text to its kernel values against a few
texts, whitened by the landmarks' own kernel matrix; one ridge regression per
language (one against the rest) is fitted there. Scoring whole texts is a batched
product of presence rows with landmark rows.

The n-grams are those of the landmarks, over all characters of the landmarks (every
other character is one symbol), so a text's row has a fixed width; a row is normalised by
the number of these n-grams that it holds.

Every label that occurs is learned. Fitting uses at most ``PER_LANG`` documents of each
language and about ``SAMPLE`` in all, texts of at most ``FIT_CHARS`` characters first and then
those with the smallest hash of their row: a bounded sample, as its size is a documented
parameter. Every text is scored as a whole.

Defined results: null text, empty text or a text without a letter is ``und`` with
score 0. Without any labelled document every text is ``und``. A repeated row is
scored alike; extra columns pass through.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_chunks

#: Parameters: documents per language to fit on and in all, landmarks per language and in all, characters of a
#: text that is preferred for fitting, n-grams up to, ridge, entries of a table by n-gram (larger ones are searched).
PER_LANG, SAMPLE, LANDMARKS, ALL_LANDMARKS, FIT_CHARS, N_MAX, RIDGE, TABLE = 256, 16384, 64, 2048, 20_000, 3, 1e-3, 1 << 22
#: Characters of a text that are turned into codes at a time.
PIECE = 1 << 18


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


class Grams:
    """Presence rows over the n-grams of the landmarks."""

    def __init__(self, texts: list[str]):
        self.symbols = np.unique(np.concatenate([codes_of(t) for t in texts] or [np.zeros(0, np.uint32)]))
        self.base = len(self.symbols) + 1
        ids = [np.unique(np.concatenate([c for t in texts for c in self._grams(t, n)] or [np.zeros(0, np.int64)]))
               for n in range(1, N_MAX + 1)]
        self.width = sum(map(len, ids))
        self.tables = []
        at = 0
        for n, x in enumerate(ids, 1):
            if self.base ** n <= TABLE:
                table = np.full(self.base ** n, self.width, np.int32)
                table[x] = np.arange(at, at + len(x))
            else:
                table = None
            self.tables.append((table, x, at))
            at += len(x)

    def _places(self, g: np.ndarray, table, x: np.ndarray, at: int) -> np.ndarray:
        """Column of every n-gram; those of no landmark share the last one."""
        if table is not None:
            return table[g]
        k = np.minimum(np.searchsorted(x, g), len(x) - 1)
        return np.where(x[k] == g, at + k, self.width)

    def _grams(self, text: str, n: int):
        codes = codes_of(text)
        for i in range(0, max(1, len(codes)), PIECE):
            c = codes[i:i + PIECE + N_MAX - 1]
            at = np.searchsorted(self.symbols, c)
            at[at == len(self.symbols)] = 0
            s = np.where(self.symbols[at] == c, at + 1, 0).astype(np.int64) if len(self.symbols) else np.zeros(len(c), np.int64)
            g = s
            for k in range(1, n):
                g = g[:-1] * self.base + s[k:]
            yield g

    def rows(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.width + 1), np.float32)
        for i, t in enumerate(texts):
            for n, (table, x, at) in enumerate(self.tables, 1):
                for g in self._grams(t, n) if len(x) else ():
                    out[i, self._places(g, table, x, at)] = 1
        return out[:, :self.width]


class Model:
    """Landmark rows, whitening and one ridge regression per language."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.langs = sorted(set(langs))
        each = max(1, min(LANDMARKS, ALL_LANDMARKS // len(self.langs)))
        marks = [t for lang in self.langs for t in [x for x, y in zip(texts, langs) if y == lang][:each]]
        self.grams = Grams(marks)
        rows = self.grams.rows(marks)
        self.mark_rows = self._unit(rows)
        k = self.mark_rows.astype(np.float64) @ self.mark_rows.T.astype(np.float64)
        val, vec = np.linalg.eigh(k)
        keep = val > 1e-6 * max(val.max(), 1e-12)
        self.white = vec[:, keep] / np.sqrt(val[keep])
        x = self._features(texts)
        y = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        self.mean = y.mean(axis=0)
        self.coef = np.linalg.solve(x.T @ x + RIDGE * len(x) * np.eye(x.shape[1]), x.T @ (y - self.mean))

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))

    def _features(self, texts: list[str]) -> np.ndarray:
        parts = [self._unit(self.grams.rows(texts[i:i + 64])) @ self.mark_rows.T for i in range(0, len(texts), 64)]
        return np.concatenate(parts).astype(np.float64) @ self.white

    @property
    def nothing(self) -> float:
        """The score of a text that shares nothing with any landmark."""
        return float((self.mean.max() + 1) / 2)

    def margins(self, texts: list[str]) -> np.ndarray:
        return self._features(texts) @ self.coef + self.mean


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text) if len(text) < 4096 else any(
        unicodedata.category(c)[0] == "L" for c in set(text))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model | None:
    """Fit on a bounded sample of every label's documents (see above); ``key`` only tells rows apart and may be null."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}"))
    labels = known.select(lang).distinct().count()
    if not labels:
        return None
    each = max(1, min(PER_LANG, SAMPLE // labels))
    known = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("h"),
                         (F.length(text) > FIT_CHARS).alias("long"))
    order = Window.partitionBy("lang").orderBy("long", "h")
    # ``each`` rows a label; the window keeps no more of a label in any task.
    picked = (known.select("lang", "long", "h").distinct().withColumn("r", F.row_number().over(order))
              .where(F.col("r") <= each).select("lang", "h"))
    rows = known.join(F.broadcast(picked), ["lang", "h"]).select("lang", "text", "h").distinct().collect()
    rows.sort(key=lambda r: (r["h"], r["lang"], r["text"]))
    return Model([r["text"] for r in rows], [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1: the best response, -1..1 mapped to 0..1)."""
    out = docs.drop("lang_pred", "score")
    schema = pa_schema(out)
    # Pickled here by value, so that executors need no copy of this package.
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def run(it):
        m = cloudpickle.loads(sent.value)
        for b, texts in text_chunks(it, text, 1 << 19):
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            todo = [i for i, t in enumerate(texts) if has_letter(t)] if m is not None else []
            for s in range(0, len(todo), 64):
                part = todo[s:s + 64]
                g = m.margins([texts[i] for i in part])
                best = g.argmax(axis=1)
                pred[part] = [m.langs[x] for x in best]
                score[part] = np.clip((g[np.arange(len(part)), best] + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score)], schema=schema)

    from pyspark.sql.types import DoubleType, StringType, StructType

    full = StructType([*out.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    return out.mapInArrow(run, full)


def pa_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema).append(pa.field("lang_pred", pa.string())).append(pa.field("score", pa.float64()))


def held_out(mod: int, rest: int):
    return F.crc32(F.col("doc_id").cast("string")) % mod == rest


def op6_query(docs: DataFrame) -> DataFrame:
    held = F.coalesce(held_out(4, 2), F.lit(False))
    model = fit(docs.where(~held).select("doc_id", "text", "lang"))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
