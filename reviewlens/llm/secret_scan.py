"""Secret scans: fixed patterns, and a likelihood test for random strings.

Two first-order Markov models over characters, one of random strings and one of
ordinary words and identifiers, are counted from labelled samples: what the fixed
patterns caught plus drawn random strings on one side, the remaining tokens on
the other. A long token whose log-likelihood ratio passes a threshold is a
finding of its own. Everything is DataFrame work; the models are two count
tables of bounded size that end up as one array in the plan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import text_or_empty
from reviewlens.session import store

# The base patterns, with the group and length a match must have.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]+"
MIN_RANDOM = 16  # characters a token needs to be tested
MIN_LEARNT = 6  # characters a token needs to be learnt from
SAMPLE_DOCS = 5_000  # documents the models are counted on, at most about
SMOOTHING = 0.5  # added to the count of every single character
BACKOFF = 10.0  # pairs seen less often than this lean on the single characters
THRESHOLD = 12.0  # nats in favour of a random string
MARK = "[SECRET]"

KINDS = ("assign", "access", "hex", "random")


def _runs(pattern: str, shortest: int) -> str:
    """The pattern with its closing + raised to a shortest length of the match.

    Only for patterns whose matches are whole runs of one character class, where
    a run that is too short holds no longer match."""
    fixed = 4 if pattern == ACCESS else 0
    return f"{pattern[:-1]}{{{shortest - fixed},}}"


def _matches(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Array of (start, kind, end) of the leftmost non-overlapping matches.

    The text between the matches gives their places: positions add up along
    the pieces. ``keep`` decides on a match and its second group.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if keep else found
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), found.alias("match"), group.alias("group")
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(acc: Column, piece: Column) -> Column:
        start = acc["at"] + F.length(piece["gap"])
        end = start + F.coalesce(F.length(piece["match"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))
        wanted = piece["match"].isNotNull() & (keep(piece["group"]) if keep else F.lit(True))
        spans = F.when(wanted, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    initial = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    listed = F.aggregate(pieces, initial, step, lambda acc: acc["spans"])
    return F.when(text.rlike(pattern), listed).otherwise(empty)


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the fixed patterns by kind."""
    return {
        "assign": _matches(text, ASSIGN, "assign", lambda group: F.length(group) >= MIN_ASSIGNED),
        "access": _matches(text, _runs(ACCESS, MIN_ACCESS), "access"),
        "hex": _matches(text, _runs(HEX, MIN_HEX), "hex"),
    }


@dataclass(frozen=True)
class RandomModel:
    """``ratio[previous, next]``, flat: log P(next | previous) as a random string
    minus the same as an ordinary token; characters by place in ``ALPHABET``."""

    ratio: list[float]
    threshold: float = THRESHOLD

    def llr(self, token: Column) -> Column:
        """Log-likelihood ratio of a token, in nats."""
        letters = F.split(token, "")
        places = F.transform(letters, lambda c: F.instr(F.lit(ALPHABET), c) - 1)
        ratios = F.lit(self.ratio)
        steps = F.zip_with(
            F.slice(places, F.lit(1), F.size(places) - 1), F.slice(places, F.lit(2), F.size(places) - 1),
            lambda a, b: F.get(ratios, a * len(ALPHABET) + b),
        )
        return F.aggregate(steps, F.lit(0.0), lambda total, x: total + x)


def _char_pairs(tokens: DataFrame) -> DataFrame:
    """(kind, previous, next, n) over the tokens' neighbouring characters."""
    letters = tokens.select(
        "kind", F.transform(F.split("token", ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1).alias("p")
    )
    pairs = F.zip_with(
        F.slice("p", F.lit(1), F.size("p") - 1), F.slice("p", F.lit(2), F.size("p") - 1),
        lambda a, b: a * len(ALPHABET) + b,
    )
    return (
        letters.filter((F.size("p") > 1) & ~F.array_contains("p", -1))
        .select("kind", F.explode(pairs).alias("pair")).groupBy("kind", "pair").count()
    )


def train_random_model(
    texts: DataFrame, sample_docs: int = SAMPLE_DOCS, threshold: float = THRESHOLD
) -> RandomModel:
    """Count both models on about ``sample_docs`` documents of (doc_id, text).

    Random strings: what the base patterns caught, and per document one drawn
    string in each of two spellings (digests of its id). Ordinary: all other
    tokens of six characters or more. Without documents the ratio is zero and
    nothing is found.
    """
    total = texts.select("doc_id").count()
    step = max(1, -(-total // sample_docs))
    sample = store(
        texts.filter(F.pmod(F.xxhash64(F.lit("secrets"), "doc_id"), F.lit(step)) == 0), "secret-sample"
    )
    patterns = [ASSIGN, _runs(ACCESS, MIN_ACCESS), _runs(HEX, MIN_HEX)]
    rest = F.col("text")
    for pattern in patterns:
        rest = F.regexp_replace(rest, pattern, " ")
    drawn = F.sha2(F.concat(F.lit("drawn"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    spelled = [F.base64(F.unhex(F.substring(drawn, 1, 48))), F.substring(drawn, 1, 40)]
    caught = [
        F.regexp_extract_all("text", F.lit(patterns[0]), F.lit(2)),
        F.regexp_extract_all("text", F.lit(patterns[1]), F.lit(0)),
        F.regexp_extract_all("text", F.lit(patterns[2]), F.lit(0)),
    ]
    ordinary = F.regexp_extract_all(rest, F.lit(f"{TOKEN[:-1]}{{{MIN_LEARNT},}}"), F.lit(0))
    tokens = sample.select(F.explode(F.flatten(F.array(*caught, F.array(*spelled)))).alias("token")).select(
        F.lit("random").alias("kind"), "token"
    ).unionByName(sample.select(F.lit("ordinary").alias("kind"), F.explode(ordinary).alias("token")))
    k = len(ALPHABET)
    counts = {"random": [0] * k * k, "ordinary": [0] * k * k}
    for row in _char_pairs(tokens).collect():  # no more rows than pairs of characters
        counts[row["kind"]][row["pair"]] = row["count"]
    if not any(counts["ordinary"]):
        return RandomModel([0.0] * k * k, threshold)

    def logs(n: list[int]) -> list[float]:
        sums = [sum(n[i * k:(i + 1) * k]) for i in range(k)]
        single = [(sum(n[j::k]) + SMOOTHING) / (sum(n) + SMOOTHING * k) for j in range(k)]
        return [math.log((n[i * k + j] + BACKOFF * single[j]) / (sums[i] + BACKOFF)) for i in range(k) for j in range(k)]

    pairs = zip(logs(counts["random"]), logs(counts["ordinary"]), strict=True)
    return RandomModel([a - b for a, b in pairs], threshold)


def _random_spans(text: Column, base: Column, model: RandomModel) -> Column:
    """Tokens that the model takes for random and no base span touches."""
    pattern = f"{TOKEN[:-1]}{{{MIN_RANDOM},}}"
    places = _matches(text, pattern, "random")

    def counts(span: Column) -> Column:
        free = ~F.exists(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
        token = F.substring(text, span["start"] + 1, span["end"] - span["start"])
        mixed = token.rlike("[0-9]") & token.rlike("[A-Za-z]") | token.rlike("[a-z][A-Z]")
        return F.when(free & mixed, model.llr(token) > model.threshold).otherwise(False)

    return F.filter(places, counts)


def spelled(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: RandomModel | None = None,
    carry: tuple[str, ...] = (), **bounds,
) -> DataFrame:
    """doc_id, text and the arrays of (start, kind, end) ``base`` and ``spans``,
    in code points, end exclusive, ordered by start, then kind, then end.

    Whole texts are scanned; a null text counts as empty and has no spans. Rows
    are scanned one by one, repeated ones and null ids too. Of the other columns
    only ``carry`` is kept; an empty table gives an empty result.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), *carry)
    if model is None:
        model = train_random_model(texts.select("doc_id", "text"), **bounds)
    by_kind = base_spans(F.col("text"))
    found = texts.withColumns({f"_{kind}": spans for kind, spans in by_kind.items()})
    base = found.withColumn("base", F.sort_array(F.concat(*[f"_{kind}" for kind in by_kind])))
    added = base.withColumn("_random", _random_spans(F.col("text"), F.col("base"), model))
    return added.withColumn("spans", F.sort_array(F.concat("base", "_random"))).drop(
        *[f"_{kind}" for kind in by_kind], "_random"
    )


def redact(scanned: DataFrame, mark: str = MARK) -> DataFrame:
    """Replace every span, overlapping ones together, by ``mark`` in ``text``."""
    def step(acc: Column, span: Column) -> Column:
        fresh = span["start"] >= acc["at"]
        between = F.substring(F.col("text"), acc["at"] + 1, span["start"] - acc["at"])
        out = F.when(fresh, F.concat(acc["out"], F.array(between, F.lit(mark)))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], span["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = F.aggregate(
        "spans", start, step,
        lambda acc: F.concat(
            F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))
        ),
    )
    return scanned.withColumn("text", F.when(F.size("spans") > 0, rest).otherwise(F.col("text")))
