"""Language identification by prediction by partial matching (PPM).

For every language a byte context tree of variable order is trained: each
context keeps how often which byte followed, and an escape to the next shorter
context with probability d / (n + d) for d different bytes among n (method C),
bytes already offered by the longer context being excluded. Below the empty
context all 256 bytes are equally likely. The counts are frozen after training,
so a text has an exact code length under every language, and the shortest wins.

The trees are fitted on a bounded sample of labelled documents and folded into
one table: a row for every context known to any language, with the code length
of each byte under each language. Scoring looks up the longest known context of
every byte, all bytes of a text at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import text_or_empty

SAMPLE_DOCS = 400  # labelled documents per language, at most about
SAMPLE_BYTES = 8_000  # of each of them, from a place set by its hash
MAX_LANGUAGES = 256
ORDER = 3
MIN_COUNT = 8  # of a context, over all languages, to get a row of its own
MAX_TABLE_BYTES = 256 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class ContextTrees:
    """``symbols``: byte -> column; ``starts``: the row of the longest known
    context for every three symbols; ``bits[row, symbol, language]``."""

    languages: list[str]
    order: int
    symbols: np.ndarray
    starts: np.ndarray
    bits: np.ndarray

    def code_lengths(self, data: bytes) -> np.ndarray:
        """Bits of a text under every language."""
        total = np.zeros(len(self.languages))
        width = self.bits.shape[1]
        padded = np.concatenate([
            np.full(self.order, width - 1, np.int64), self.symbols[np.frombuffer(data, np.uint8)]
        ])
        for at in range(0, len(data), 1 << 18):  # bounds the memory for very long texts
            part = padded[at:at + (1 << 18) + self.order]
            n = len(part) - self.order
            context = np.zeros(n, np.int64)
            for k in range(self.order):
                context = context * width + part[k:k + n]
            rows = self.starts[context]
            total += self.bits[rows, part[self.order:]].sum(axis=0, dtype=np.float64)
        return total


def fit(samples: list[tuple[str, bytes]], order: int = ORDER, min_count: int = MIN_COUNT) -> ContextTrees:
    """Train the trees on (language, text) pairs.

    Bytes never seen share one column; there they are told apart by nothing, so
    each costs the same in every language. A text starts in that column.
    """
    languages = sorted({language for language, _ in samples})
    seen = np.zeros(256, bool)
    for _, data in samples:
        seen[np.unique(np.frombuffer(data, np.uint8))] = True
    width = int(seen.sum()) + 1
    symbols = np.full(256, width - 1, np.int64)
    symbols[seen] = np.arange(width - 1)
    unseen = 256 - (width - 1)
    if width ** order * 4 > MAX_TABLE_BYTES:
        raise ValueError("too many different bytes for contexts of this order")

    # how often each byte followed each context of full order, by language
    full: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for language in languages:
        grams = []
        for own, data in samples:
            if own != language:
                continue
            s = np.concatenate([np.full(order, width - 1, np.int64), symbols[np.frombuffer(data, np.uint8)]])
            n = len(data)
            code = np.zeros(n, np.int64)
            for k in range(order + 1):
                code = code * width + s[k:k + n]
            grams.append(code)
        values, times = np.unique(np.concatenate(grams), return_counts=True)
        full.append(values)
        counts.append(times)

    # the rows below the empty context: all bytes alike, the unseen ones together
    rows = np.full((1, len(languages), width), 1.0 / 256)
    rows[:, :, -1] = unseen / 256
    below, starts = np.zeros(1, np.int64), np.zeros(1, np.int64)
    weights = np.concatenate(counts)
    for k in range(order + 1):
        grams = [values % width ** (k + 1) for values in full]  # the last k bytes and the next one
        contexts, inverse = np.unique(np.concatenate(grams) // width, return_inverse=True)
        if k:
            contexts = contexts[np.bincount(inverse, weights, len(contexts)) >= min_count]
            below = starts[contexts % width ** (k - 1)]
        made = np.empty((len(contexts), len(languages), width))
        for own, (gram, times) in enumerate(zip(grams, counts, strict=True)):
            place = np.searchsorted(contexts, gram // width)
            known = np.isin(gram // width, contexts)
            c = np.zeros((len(contexts), width))
            np.add.at(c, (place[known], gram[known] % width), times[known])
            n, d = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
            shorter = rows[below, own]
            rest = np.maximum(1.0 - (shorter * (c > 0)).sum(axis=1, keepdims=True), 1e-12)
            with np.errstate(invalid="ignore"):
                made[:, own] = np.where(
                    n == 0, shorter, np.where(c > 0, c / (n + d), d / (n + d) * shorter / rest)
                )
        if k:
            starts = np.tile(starts, width)  # a longer context ends in the shorter one
            starts[contexts] = len(rows) + np.arange(len(contexts))
            rows = np.concatenate([rows, made])
        else:
            rows = made
    per_byte = np.where(np.arange(width) == width - 1, max(unseen, 1), 1)
    bits = -np.log2(np.maximum(rows / per_byte, 1e-30))
    bits = np.ascontiguousarray(bits.transpose(0, 2, 1).astype(np.float32))
    if bits.nbytes > MAX_TABLE_BYTES:
        raise ValueError("the folded trees are larger than their bound; raise min_count")
    return ContextTrees(languages, order, symbols, starts.astype(np.int32), bits)


def language_sample(
    labelled: DataFrame, id_col: str, text_col: str, lang_col: str,
    sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES,
) -> list[tuple[str, bytes]]:
    """Texts to train on: about ``sample_docs`` per language picked by a hash of
    the id, of each a stretch of at most ``sample_bytes`` bytes. This bounded
    sample is all that comes to the driver."""
    usable = labelled.filter(F.col(lang_col).isNotNull() & (F.octet_length(F.col(text_col)) > 0))
    totals = usable.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES)
    sizes = {row["lang"]: row["count"] for row in totals.collect()}
    spread = F.pmod(F.xxhash64(F.lit("language"), F.col(id_col)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    picked = F.lit(False)
    for lang, n in sizes.items():
        picked = F.when(F.col(lang_col) == lang, spread < F.lit(sample_docs / n)).otherwise(picked)
    characters = sample_bytes // 4  # a character has four bytes at most
    room = F.greatest(F.length(text_col) - characters, F.lit(0)) + 1
    begin = F.pmod(F.xxhash64(F.lit("place"), F.col(id_col)), room.cast("long")).cast("int") + 1
    rows = (
        usable.filter(picked)
        .select(F.col(lang_col).alias("lang"), F.substring(F.col(text_col), begin, F.lit(characters)).alias("text"))
        .limit(2 * sample_docs * max(1, len(sizes)))
        .collect()
    )
    return sorted((row["lang"], row["text"].encode("utf-8", "replace")) for row in rows)


def identify(docs: DataFrame, trees: ContextTrees | None, text: Column) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (the share of the winner's probability
    among all languages, each taken as equally likely beforehand).

    A null text, one without a letter, or a model without languages gives
    ``und`` and score 0. Languages with equal code length go to the first by name.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("lang string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = model.value
        for texts in batches:
            out = []
            for t in texts:
                if own is None or not any(map(str.isalpha, t)):
                    out.append((UNKNOWN, 0.0))
                    continue
                bits = own.code_lengths(t.encode("utf-8", "replace"))
                best = int(np.argmin(bits))
                out.append((own.languages[best], float(1.0 / np.exp2(bits[best] - bits).sum())))
            yield pd.DataFrame(out, columns=["lang", "score"])

    return (
        docs.withColumn("_predicted", predicted(text_or_empty(text)))
        .withColumns({"lang_pred": F.col("_predicted.lang"), "score": F.col("_predicted.score")})
        .drop("_predicted")
    )


def predict_languages(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    **bounds,
) -> DataFrame:
    """doc_id, lang_pred and score of every whole text, learnt from the rows
    where ``training`` holds. Repeated rows and null ids are judged row by row;
    other columns are not looked at; an empty table gives an empty result."""
    samples = language_sample(docs.filter(training), id_col, text_col, lang_col, **bounds)
    trees = fit(samples) if samples else None
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return identify(texts, trees, F.col("_text")).drop("_text")
