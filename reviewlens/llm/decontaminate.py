"""Benchmark decontamination by one Aho-Corasick automaton over normalised test items.

Texts are normalised to words: A-Z in lower case, everything but digits, letters
and characters beyond ASCII is a gap. Every distinct word of the test items
(questions and answers) becomes one symbol, and an item is cut into its windows of ten consecutive
words; a shorter item is one window. The automaton holds all windows. A document
becomes a string of symbols, one for each word, and is scanned once; a match ends
at a word, so its offsets in the original text are those of its words.

The windows are counted before any of them is sent to the tasks. An automaton
takes ``block_windows`` of them. Test sets with more windows make several
automata; the documents are scanned once for each, the findings are joined by a
digest of the text and united. No window is dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.session import store

WINDOW = 10  # consecutive words of an item that count as its passage
BLOCK_WINDOWS = 100_000  # (window, item) pairs in one automaton, about; some 100 MB in a Python worker

# What parts words, and which letters are lowered.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256)
)
_OTHER = "\0"  # the symbol of words that no item has
_FOUND = "n_words long, first array<int>, last array<int>, start array<int>, stop array<int>, items array<string>"


class WindowAutomaton:
    """Windows as (words joined by blanks, ids of the items that hold them)."""

    def __init__(self, windows: list[tuple[str, list[str]]]):
        import ahocorasick

        self.symbols: dict[bytes, str] = {}
        self.automaton = ahocorasick.Automaton()
        self.items = []
        for at, (window, items) in enumerate(windows):
            words = window.encode("utf-8", "surrogatepass").split(b" ")
            self.automaton.add_word("".join(map(self._symbol, words)), (len(words), at))
            self.items.append(items)
        if windows:
            self.automaton.make_automaton()

    def _symbol(self, word: bytes) -> str:
        known = self.symbols.get(word)
        if known is None:
            code = len(self.symbols) + 1
            known = self.symbols[word] = chr(code if code < 0xD800 else code + 0x800)  # surrogates left out
        return known

    def scan(self, text: bytes) -> tuple[int, list, list, list, list, list]:
        """(words, first and last words of the runs of hit words, their offsets
        in code points of the text, the stop exclusive, item ids)."""
        gapped = text.translate(_BYTES)
        words = gapped.split()
        if not words or not self.items:
            return len(words), [], [], [], [], []
        found = list(self.automaton.iter("".join(map(self.symbols.get, words, repeat(_OTHER)))))
        if not found:
            return len(words), [], [], [], [], []
        edge = np.zeros(len(words) + 1, np.int64)
        for stop, (length, _) in found:
            edge[stop - length + 1] += 1
            edge[stop + 1] -= 1
        hit = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
        turns = np.flatnonzero(hit[1:] != hit[:-1])
        first, last = turns[::2], turns[1::2] - 1
        inside = np.concatenate([[False], np.frombuffer(gapped, np.uint8) != 32, [False]])
        places = np.flatnonzero(inside[1:] != inside[:-1])  # bytes at which words start and stop
        characters = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
        start, stop = characters[places[::2][first]] - 1, characters[places[1::2][last] - 1]
        items = set().union(*(self.items[at] for at in {at for _, (_, at) in found}))
        return (len(words), first.tolist(), last.tolist(), start.tolist(), stop.tolist(), sorted(items))


def normalised_words(text: Column) -> Column:
    """The words of a text, normalised, in order."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, GAP), lambda w: w != "")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (window, item_id) of all items; ids as text."""
    worded = items.select(F.col(id_col).cast("string").alias("item_id"), normalised_words(F.col(text_col)).alias("w"))
    length = F.least(F.lit(WINDOW), F.size("w"))
    windows = F.transform(
        F.sequence(F.lit(1), F.size("w") - length + 1), lambda at: F.array_join(F.slice("w", at, length), " ")
    )
    return worded.filter(F.size("w") > 0).select("item_id", F.explode(windows).alias("window")).distinct()


_automata: dict[str, WindowAutomaton] = {}


def _finder(docs: DataFrame, windows: DataFrame):
    """The scan for one block of windows as a column function."""
    rows = windows.groupBy("window").agg(F.collect_list("item_id").alias("items")).collect()
    pairs = [(r["window"], r["items"]) for r in rows]
    sent, key = docs.sparkSession.sparkContext.broadcast(pairs), uuid.uuid4().hex

    @F.pandas_udf(_FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if key not in _automata:
            _automata.clear()  # one automaton in a worker process
            _automata[key] = WindowAutomaton(sent.value)
        scan = _automata[key].scan
        for texts in batches:
            yield pd.DataFrame(
                [scan(t or b"") for t in texts], columns=["n_words", "first", "last", "start", "stop", "items"]
            )

    return find


def _united(columns: list[str]):
    """Unite the findings of several automata in one text."""

    @F.pandas_udf("first array<int>, last array<int>, start array<int>, stop array<int>")
    def unite(first: pd.Series, last: pd.Series, start: pd.Series, stop: pd.Series) -> pd.DataFrame:
        out = []
        for runs in zip(first, last, start, stop, strict=True):
            united: list[list[int]] = []
            for a, b, c, d in sorted(zip(*(map(int, r) for r in runs), strict=True)):
                if united and a <= united[-1][1] + 1:
                    if b > united[-1][1]:
                        united[-1][1], united[-1][3] = b, d
                else:
                    united.append([a, b, c, d])
            out.append([list(x) for x in zip(*united, strict=True)] or [[], [], [], []])
        return pd.DataFrame(out, columns=["first", "last", "start", "stop"])

    return unite(*[F.flatten(c) for c in columns])


def _scanned(docs: DataFrame, items: DataFrame, text: Column, item_id: str, item_text: str, block_windows: int) -> DataFrame:
    """Row ``doc`` of every document and ``found`` in its text."""
    windows = store(item_windows(items, item_id, item_text), "windows")
    blocks = 1 + windows.count() // block_windows
    block = F.pmod(F.xxhash64("window", "item_id"), F.lit(blocks))
    texts = docs.select(F.struct("*").alias("doc"), F.coalesce(text.cast("string"), F.lit("")).cast("binary").alias("t"))
    digest = F.sha2("t", 256)
    scanned = texts.select("doc", digest.alias("d") if blocks > 1 else F.lit(None).alias("d"),
                           _finder(docs, windows.filter(block == 0))("t").alias("found"))
    if blocks == 1:
        return scanned.select("doc", "found")
    more = None
    for at in range(1, blocks):
        part = texts.select(digest.alias("d"), F.lit(at).alias("at"),
                            _finder(docs, windows.filter(block == at))("t").alias("f"))
        part = store(part.filter(F.size("f.first") > 0).dropDuplicates(["d"]), "findings")
        more = part if more is None else more.unionByName(part)
    parts = ["first", "last", "start", "stop", "items"]
    more = more.groupBy("d").agg(*[F.collect_list(F.struct("at", F.col(f"f.{p}").alias("found"))).alias(p) for p in parts])
    more = more.select("d", *[F.transform(F.array_sort(p), lambda x: x["found"]).alias(p) for p in parts])
    joined = scanned.join(more, "d", "left").select("doc", F.col("found.n_words").alias("n_words"), *[
        F.concat(F.array(f"found.{p}"), F.coalesce(F.col(p), F.array().cast(f"array<array<{'string' if p == 'items' else 'int'}>>"))).alias(p)
        for p in parts
    ])
    united = joined.select("doc", "n_words", _united(parts[:4]).alias("u"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))
    return united.select("doc", F.struct("n_words", "u.first", "u.last", "u.start", "u.stop", "items").alias("found"))


def find_contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """doc_id, ``n_words``, ``n_hit`` (words inside an occurrence of a window),
    ``items`` (sorted ids, as text, of the items with occurring windows) and
    ``spans`` (start and stop in code points of the text, of each run of hit words).

    A null or empty text has no words, and neither has a text of gaps only: as a
    document it holds nothing, as an item it has no window. Windows of an item
    with a null id count as hits, but name no item. Items of equal ids are one
    item. Every document row is judged by itself, repeated rows and null ids
    too; other columns are not looked at. Without items nothing is hit, and an
    empty table stays empty. ``block_windows`` is at most 110,000, so that there
    are symbols for all words of a block.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = _scanned(own, items, F.col("text"), item_id_col, item_text_col, block_windows)
    words = F.aggregate(
        F.arrays_zip(F.col("found.first").alias("first"), F.col("found.last").alias("last")), F.lit(0).cast("long"),
        lambda n, run: n + run["last"] - run["first"] + 1,
    )
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), F.col("found.n_words").alias("n_words"), words.alias("n_hit"),
        F.col("found.items").alias("items"), F.arrays_zip("found.start", "found.stop").alias("spans"),
    )


def cut_passages(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The documents with every run of hit words cut out of the text; gaps and
    all other columns stay as they are, a null text stays null."""
    found = _scanned(docs, items, F.col(f"`{text_col}`"), item_id_col, item_text_col, block_windows)
    text = F.col("doc").getField(text_col)
    starts = F.concat(F.array(F.lit(0)), F.col("found.stop"))
    stops = F.concat(F.col("found.start"), F.array(F.length(text)))
    kept = F.array_join(F.zip_with(starts, stops, lambda a, b: F.substring(text, a + 1, b - a)), "")
    clean = F.when(F.size("found.first") > 0, kept).otherwise(text)
    return found.select(*[
        (clean if c == text_col else F.col("doc").getField(c)).alias(c) for c in docs.columns
    ])
