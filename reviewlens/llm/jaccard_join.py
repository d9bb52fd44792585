"""N-gram Jaccard join by chosen paths.

Documents are sets of word shingles, equal sets are one set. Sets are embedded
as minimum hashes, samples of their tokens on which two sets agree as often as
they are similar. Every run splits all sets on one sampled token; sets that share
it meet in a bucket. Buckets small enough are compared in full, larger ones are
split again on newly sampled tokens, each time into as many expected copies as
keep pairs at the threshold alive and let others die out. The number of runs
follows from the wanted recall.

Meeting pairs are tested on their sketches with a margin, and what passes is
only used to connect candidates, by few edges per bucket. Each connected set of
candidates is then compared in full on its exact shingle sets, block against
block, so links and classes are exact within it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm import shingles
from reviewlens.llm.common import text_or_empty
from reviewlens.session import store

SIMILARITY = 0.8
TARGET_RECALL = 0.9999
BUCKET_SETS = 1_024  # sets of a bucket that are compared in full
MAX_DEPTH = 8  # then what is left of a bucket is compared block by block
BLOCK_SHINGLES = 1_000_000  # shingles of a block in the exact comparison
SKETCH_SLACK = 5.0  # standard deviations that a sketch may fall short
BATCH_ROWS = 4_096
EDGES_PER_TASK = 100_000  # where the number of edges is known


def runs_for(similarity: float, recall: float) -> int:
    """Runs that find a pair at the threshold with the wanted probability, if it
    takes a second split: it survives the first with the probability of its
    similarity, the second, with 1 / similarity tokens on average, a bit better."""
    extra = 1 / similarity - 1
    second = 1 - ((1 - extra) * (1 - similarity) + extra * (1 - similarity) ** 2)
    return min(shingles.SKETCH, math.ceil(math.log(1 - recall) / math.log(1 - similarity * second)))


def sketch_matches(similarity: float) -> int:
    """Equal minimum hashes that a pair at the threshold has all but surely."""
    n = shingles.SKETCH
    return math.floor(n * similarity - SKETCH_SLACK * math.sqrt(n * similarity * (1 - similarity)))


def _streamed(df: DataFrame, key: list[str], schema: str, fn: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Apply ``fn`` to stretches of whole key groups, many small groups at once."""
    columns = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_rows: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            last = batch[key].iloc[-1]
            same = (batch[key] == last).all(axis=1).to_numpy()
            first = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if first or (open_rows and not (open_rows[-1][key].iloc[-1] == last).all()):
                done = pd.concat([*open_rows, batch.iloc[:first]], ignore_index=True)
                open_rows = []
                if len(done):
                    yield fn(done)
            open_rows.append(batch.iloc[first:])
        if open_rows:
            yield fn(pd.concat(open_rows, ignore_index=True))

    return df.repartition(*key).sortWithinPartitions(*key).select(*columns).mapInPandas(run, schema)


class _Union:
    """Classes of row numbers, joined pair by pair."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Join pairs; true for those that were in different classes before."""
        apart = self.root[a] != self.root[b]
        while True:
            low, high = np.minimum(self.root[a], self.root[b]), np.maximum(self.root[a], self.root[b])
            if (low == high).all():
                return apart
            np.minimum.at(self.root, high, low)
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]


_EDGE = "a long, b long"


def _compare_buckets(least: int, similarity: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Edges between sets of a bucket whose sketches agree. Rows come sorted by
    bucket; every row meets the d-th after it, for d = 1, 2, ... Rows that are
    already connected, here or by label, are not compared again."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        bucket, label = rows["bucket"].to_numpy(), pd.factorize(rows["label"])[0]
        sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint16).reshape(len(rows), shingles.SKETCH)
        n, ids = rows["n"].to_numpy(), rows["sid"].to_numpy()
        classes = _Union(len(rows))
        order = np.lexsort((label, bucket))
        a, b = order[:-1], order[1:]
        known = (bucket[a] == bucket[b]) & (label[a] == label[b])
        classes.join(a[known], b[known])
        edges = []
        for d in range(1, len(rows)):
            i = np.flatnonzero(bucket[:-d] == bucket[d:])
            if not len(i):
                break
            i = i[classes.root[i] != classes.root[i + d]]
            small, large = np.minimum(n[i], n[i + d]), np.maximum(n[i], n[i + d])
            i = i[small >= similarity * large]
            hits = [
                part[(sketch[part] == sketch[part + d]).sum(axis=1) >= least]
                for part in (i[at:at + BATCH_ROWS] for at in range(0, len(i), BATCH_ROWS))
            ]
            i = np.concatenate(hits) if hits else i
            if len(i):
                i = i[classes.join(i, i + d)]
                edges.append(np.stack([i, i + d], axis=1))
        pairs = np.concatenate(edges) if edges else np.empty((0, 2), int)
        return pd.DataFrame({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

    return compare


def connect(edges: DataFrame) -> DataFrame:
    """(sid, label): the connected classes of edges (a, b), by contraction.

    In every round each node takes the smallest name among itself and its
    neighbours; the edges are renamed, and those inside one class fall away.
    """
    def kept(df: DataFrame, name: str, rows: int) -> DataFrame:
        """Write a table that has no more than so many rows, in as few files."""
        return store(df.coalesce(max(1, -(-rows // EDGES_PER_TASK))), name)

    edges = store(edges.filter("a <> b").distinct(), "edges")
    n = edges.count()
    labels = kept(
        edges.select(F.explode(F.array("a", "b")).alias("sid")).distinct().withColumn("label", F.col("sid")), "labels", 2 * n
    )
    nodes = 2 * n
    while n:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("old")).agg(F.min("b").alias("new")).filter(F.col("new") < F.col("old"))
        least = kept(least, "least", 2 * n)
        hop = least
        for _ in range(2):  # follow the names further
            further = least.select(F.col("old").alias("new"), F.col("new").alias("next"))
            hop = hop.join(further, "new", "left").select("old", F.coalesce("next", "new").alias("new"))
        hop = kept(hop, "renamed", 2 * n)

        def renamed(df: DataFrame, column: str, hop: DataFrame = hop) -> DataFrame:
            names = hop.select(F.col("old").alias(column), F.col("new").alias("_new"))
            return df.join(names, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")

        edges = kept(renamed(renamed(edges, "a"), "b").filter("a <> b").distinct(), "edges", n)
        labels = kept(renamed(labels, "label"), "labels", nodes)
        n = edges.count()
    return labels


def document_sets(docs: DataFrame, id_col: str, text_col: str, roots: int, words: int) -> DataFrame:
    """id, text_key and of its shingle set: digest (null without words), n, the sketch and the first ``roots`` minimum hashes in full."""

    @F.pandas_udf("digest string, n int, sketch binary, roots array<long>")
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import hashlib

        for texts in batches:
            out = []
            for text in texts:
                own = shingles.shingle_set(text, words)
                if not len(own):
                    out.append((None, 0, None, None))
                    continue
                lowest = shingles.minimum_hashes(own)
                sketch = (shingles.mixed(lowest) & np.uint64(0xFFFF)).astype(np.uint16).tobytes()
                out.append((hashlib.md5(own.tobytes()).hexdigest(), len(own), sketch, lowest[:roots].view(np.int64)))
            yield pd.DataFrame(out, columns=["digest", "n", "sketch", "roots"])

    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("id"), F.md5(text.cast("binary")).alias("text_key"), described(text).alias("_s")
    ).select("id", "text_key", "_s.*")


def _candidates(sets: DataFrame, similarity: float, runs: int, bucket_sets: int, max_depth: int) -> DataFrame:
    """(sid, label) of the sets that some candidate edge touches.

    ``sets``: stored (sid, n, sketch, roots), one row per different set.
    """
    compare = _compare_buckets(sketch_matches(similarity), similarity)
    described = sets.select("sid", "n", "sketch")
    met = sets.select("sid", F.posexplode("roots").alias("run", "token")).select(
        "sid", F.xxhash64("run", "token").alias("bucket")
    )
    labels, edges, depth = None, None, 0
    while True:
        # buckets that hold one set only, or one class only, are done
        if labels is not None:
            met = met.join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
        else:
            met = met.withColumn("label", F.col("sid"))
        sizes = met.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("size"), F.min("label").alias("_low"), F.max("label").alias("_high")
        ).filter(F.col("_low") != F.col("_high")).select("bucket", "size")
        open_rows = store(met.join(sizes, "bucket").join(described, "sid"), "buckets")
        if open_rows.isEmpty():
            break
        final = depth >= max_depth
        blocks = F.ceil(F.col("size") / bucket_sets).cast("int")
        cut = open_rows.withColumn("_block", F.pmod(F.xxhash64("sid", "bucket"), blocks.cast("long")).cast("int"))
        if final:  # every block against every other
            others = F.sequence(F.lit(0), blocks - 1)
            cut = cut.withColumn("_other", F.explode(others)).withColumn(
                "bucket",
                F.xxhash64("bucket", F.least("_block", "_other"), F.greatest("_block", "_other")),
            )
        else:
            cut = cut.withColumn("bucket", F.xxhash64("bucket", "_block"))
        found = _streamed(cut.select("bucket", "sid", "label", "n", "sketch"), ["bucket"], _EDGE, compare)
        found = store(found, "found")
        edges = found if edges is None else edges.union(found)
        labels = connect(edges)
        edges = labels.select(F.col("sid").alias("a"), F.col("label").alias("b"))  # says the same, and is short
        if final:
            break
        depth += 1
        large = open_rows.filter(F.col("size") > bucket_sets)
        if large.isEmpty():
            break
        met = _split(large, similarity)
    if labels is None:
        return sets.select("sid", F.col("sid").alias("label")).limit(0)
    return labels


def _split(large: DataFrame, similarity: float) -> DataFrame:
    """Children of large buckets: (sid, bucket) by the sampled tokens of the
    bucket, one or two of them, 1 / similarity on average."""
    n = shingles.SKETCH
    draw = F.pmod(F.xxhash64(F.lit("draw"), "bucket"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    first = F.pmod(F.xxhash64(F.lit("first"), "bucket"), F.lit(n)).cast("int")
    second = F.pmod(first + 1 + F.pmod(F.xxhash64(F.lit("second"), "bucket"), F.lit(n - 1)), F.lit(n)).cast("int")
    chosen = F.when(draw < 1 / similarity - 1, F.array(first, second)).otherwise(F.array(first))
    picked = large.select("sid", "bucket", "sketch", F.explode(chosen).alias("coordinate"))
    token = F.substring("sketch", F.col("coordinate") * 2 + 1, F.lit(2))
    return picked.select("sid", F.xxhash64("bucket", "coordinate", token).alias("bucket"))


_FOUND = "sid long, root long, links long, whole boolean"


def _exact(similarity: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Compare the shingle sets of a block pair: per set the links it has here
    (in documents) and a name shared by all it is linked with."""

    def one_pair(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[np.argsort(rows["tokens"].map(len).to_numpy(), kind="stable")].reset_index(drop=True)
        tokens = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
        sizes = np.array([len(t) for t in tokens])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        names, flat = np.unique(np.concatenate(tokens), return_inverse=True)
        own, weight = rows["own"].to_numpy(), rows["weight"].to_numpy()
        across = bool((rows["left"] != rows["right"]).iloc[0])
        links, classes, present = np.zeros(len(rows), np.int64), _Union(len(rows)), np.zeros(len(names), bool)
        for i in range(len(rows)):
            # rows come by size, so those large enough but not too large follow
            last = int(np.searchsorted(sizes, sizes[i] / similarity + 1e-9, side="right"))
            if last <= i + 1:
                continue
            mine = flat[starts[i]:starts[i] + sizes[i]]
            present[mine] = True
            at = starts[i + 1:last]
            shared = np.add.reduceat(present[flat[at[0]:starts[last - 1] + sizes[last - 1]]], at - at[0], dtype=np.int64)
            present[mine] = False
            others = np.arange(i + 1, last)
            close = shared >= similarity * (sizes[i] + sizes[others] - shared) - 1e-9
            hit = others[close & (own[others] != own[i])] if across else others[close]
            if len(hit):
                links[i] += weight[hit].sum()
                links[hit] += weight[i]
                classes.join(np.full(len(hit), i), hit)
        ids = rows["sid"].to_numpy()
        single = rows["blocks"].to_numpy() == 1
        return pd.DataFrame({"sid": ids, "root": ids[classes.root], "links": links, "whole": single})

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [one_pair(part) for _, part in rows.groupby("pair", sort=False)]
        return pd.concat(parts, ignore_index=True)

    return compare


def jaccard_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
    words: int = shingles.WORDS, recall: float = TARGET_RECALL, bucket_sets: int = BUCKET_SETS,
    max_depth: int = MAX_DEPTH, block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per document: id, ``class_id`` (the smallest id of its class),
    ``class_size`` and ``n_links`` (other documents at least as similar as asked,
    equal ones included). Classes are connected by links.

    Words are runs without ASCII white space, taken as they are. A text of fewer
    words than a shingle is one shingle. A null text, or one without a word, is
    linked to nothing and a class of its own. Repeated rows are documents of
    their own, as similar as can be; null ids never name a class if it has another.
    Other columns are not looked at; an empty table gives an empty result.
    """
    runs = runs_for(similarity, recall)
    described = store(document_sets(docs, id_col, text_col, runs, words), "sets")
    with_words = described.filter(F.col("digest").isNotNull())
    key = F.struct("text_key", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id_key"))
    sets = store(
        with_words.groupBy("digest").agg(
            F.count(F.lit(1)).alias("weight"), F.min("id").alias("least_id"), F.min(key).alias("from"),
            F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("roots").alias("roots"),
        ).withColumn("sid", F.monotonically_increasing_id()),  # a short name, fixed by being written
        "distinct-sets",
    )
    labels = _candidates(sets, similarity, runs, bucket_sets, max_depth)
    links = store(_links(docs, id_col, text_col, sets, labels, similarity, words, block_shingles), "links")
    degrees = links.groupBy("sid").agg(F.sum("links").alias("links"))
    # a set of candidates compared at one place has its classes; others go through their roots
    classes = links.filter("whole").select("sid", F.col("root").alias("label"))
    cut = links.filter("not whole")
    if not cut.isEmpty():
        classes = classes.unionByName(connect(cut.select(F.col("sid").alias("a"), F.col("root").alias("b"))))
    named = (
        sets.select("sid", "digest", "weight", "least_id").join(degrees, "sid", "left").join(classes, "sid", "left")
        .withColumn("label", F.coalesce("label", "sid"))
    )
    whole = named.groupBy("label").agg(F.min("least_id").alias("class_id"), F.sum("weight").alias("class_size"))
    result = named.join(whole, "label").select(
        "digest", "class_id", "class_size", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    joined = described.select("id", "digest").join(result, "digest", "left")
    alone = F.col("digest").isNull()
    return joined.select(
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, 1).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
    )


def _links(
    docs: DataFrame, id_col: str, text_col: str, sets: DataFrame, labels: DataFrame, similarity: float, words: int,
    block_shingles: int,
) -> DataFrame:
    """Exact comparison inside the classes of candidates: (sid, root, links)."""
    members = sets.select("sid", "weight", "n", "from").join(labels, "sid")
    volume = members.groupBy("label").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("blocks"))
    wanted = members.join(volume, "label").select(
        "sid", "weight", "label", "blocks", F.col("from.text_key").alias("text_key"), F.col("from.id_key").alias("id_key")
    )
    text = text_or_empty(text_col)
    texts = docs.select(
        F.md5(text.cast("binary")).alias("text_key"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id_key"), text.alias("text"),
    ).join(wanted, ["text_key", "id_key"]).dropDuplicates(["sid"])

    @F.pandas_udf("binary")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for own in batches:
            yield pd.Series([shingles.shingle_set(t, words).tobytes() for t in own])

    own = F.pmod(F.xxhash64("sid"), F.col("blocks").cast("long")).cast("int")
    sized = texts.select("sid", "weight", "label", "blocks", own.alias("own"), tokens("text").alias("tokens"))
    paired = sized.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("label", F.least("own", "_other"), F.greatest("own", "_other")).alias("pair"),
        F.least("own", "_other").alias("left"), F.greatest("own", "_other").alias("right"),
        "sid", "weight", "own", "blocks", "tokens",
    )
    return _streamed(paired, ["pair"], _FOUND, _exact(similarity))


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents with one of each class left, that of the smallest id; all
    columns kept. Rows are numbered in a written copy, so that of repeated rows
    exactly one stays."""
    numbered = store(docs.withColumn("_join_row", F.monotonically_increasing_id()), "numbered")
    keyed = numbered.withColumn("_join_id", F.struct(F.col(id_col), F.col("_join_row")))
    classes = jaccard_classes(keyed, "_join_id", **options)
    kept = classes.filter(F.col("id") == F.col("class_id")).select(F.col("id._join_row").alias("_join_row"))
    return numbered.join(kept, "_join_row").select(*[F.col(f"`{c}`") for c in docs.columns])
