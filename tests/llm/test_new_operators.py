"""Decontamination, Merkle manifest and vector codes beside plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import decontaminate, merkle, part_codes
from reviewlens.llm.queries import fold

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_hits(text, items):
    """(words, hit words, items, spans) by trying every window everywhere."""
    spots = list(WORD.finditer(lowered(text)))
    words, hit, named = [m[0] for m in spots], set(), set()
    for item_id, item in items:
        own = WORD.findall(lowered(item))
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            for j in range(len(words) - size + 1):
                if words[j:j + size] == own[i:i + size]:
                    hit |= set(range(j, j + size))
                    named |= {item_id}
    spans = []
    for k in sorted(hit):
        if spans and k == spans[-1][1] + 1:
            spans[-1][1] = k
        else:
            spans.append([k, k])
    return (len(words), len(hit), sorted(str(x) for x in named if x is not None),
            [(spots[a].start(), spots[b].end()) for a, b in spans])


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"),
    (2, "Short, item"), (10, "Three four FIVE six seven eight nine ten eleven twelve!"), (3, None), (4, ""), (5, "?!"),
    (6, "ünïcode ÉTÉ 日本 words"), (None, "nameless item here"), (2, "second text of two"), (7, "a a a a a a a a a a a"),
]
TEXTS = [
    None, "", "...", "short item", "Short -- ITEM; short\nitem", "prefix short items", "one TWO three/four five six seven eight nine ten",
    "x one two three four five six seven eight nine ten eleven twelve y three four five six seven eight nine ten eleven twelve",
    "🙂 ünïcode, ÉTÉ: 日本 words 🙂 tail", "ünïcode été 日本 words", "nameless item here, short item", "a " * 40,
    "one two three four five six seven eight nine" + " filler" * 5_000, "b" * 100_000, "short item",
]


@pytest.mark.parametrize("block_windows", [100_000, 3])
def test_contamination_matches_trying_everything(spark, block_windows):
    docs = spark.createDataFrame(
        [(i if i % 6 else None, t, "x", 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, found string, n_words int"
    )
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.find_contamination(docs, items, block_windows=block_windows).collect()
    want = [(i if i % 6 else None, *plain_hits(t, ITEMS)) for i, t in enumerate(TEXTS)]
    have = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"], [(s["start"], s["stop"]) for s in r["spans"]]) for r in got]
    assert sorted(map(repr, have)) == sorted(map(repr, want))
    cut = decontaminate.cut_passages(docs, items, block_windows=block_windows)
    assert cut.columns == docs.columns
    kept = sorted(x for x in (r["text"] for r in cut.collect()) if x is not None)
    expected = []
    for text in TEXTS:
        if text is not None:
            at = 0
            out = ""
            for a, b in plain_hits(text, ITEMS)[3]:
                out, at = out + text[at:a], b
            expected.append(out + text[at:])
    assert kept == sorted(expected)


def test_contamination_of_random_texts(spark):
    rng = random.Random(5)
    words = ["a", "b", "C", "d1", "é"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(30)]
    texts = ["; ".join(rng.choices(words, k=rng.randint(0, 120))) for _ in range(60)]
    got = decontaminate.find_contamination(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), block_windows=40,
    ).collect()
    for r in got:
        want = plain_hits(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["items"]) == want[:3]


def test_contamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    row = decontaminate.find_contamination(docs, items).first()
    assert (row["n_words"], row["n_hit"], row["items"], row["spans"]) == (2, 0, [], [])
    assert decontaminate.find_contamination(docs.limit(0), items).count() == 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, siblings of every leaf as (before, after) per level)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            run = i - i % 16
            path.append(("".join(level[run:i]), "".join(level[i + 1:run + 16])))
        level, at = [digest("".join(level[i:i + 16])) for i in range(0, len(level), 16)], [i // 16 for i in at]
    return (level[0] if level else None), paths


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row, plain_leaf(row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    roots, inner = [], {}
    for name in names:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        top, paths = plain_tree([leaf for _, leaf in groups[name]])
        roots.append(top)
        inner[name] = paths
    root, upper = plain_tree(roots)
    out = []
    for name, subroot, above in zip(names, roots, upper, strict=True):
        for (row, leaf), path in zip(groups[name], inner[name], strict=True):
            changed, whole = leaf, [*path, *above]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                changed = plain_leaf((*row[:4], None if row[4] is None else lowered(row[4])))
            for before, after in whole:
                changed = digest(before + changed + after)
            out.append((row[0], leaf, subroot, root, digest("".join(a + b for a, b in whole)), changed, changed == root))
    return sorted(out, key=repr)


def manifest_rows(docs):
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    changed = merkle.leaf_of([merkle.lower_cased(F.col(c)) if c == "text" else F.col(c) for c in columns])
    made = merkle.build_manifest(docs, carry={"tampered_leaf": F.when(fold("doc_id", 5) == 0, changed)})
    checked = merkle.verify(made, F.coalesce("tampered_leaf", "leaf"))
    return sorted(
        (tuple(r) for r in checked.select(
            "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256), "folded_root", "verified"
        ).collect()), key=repr,
    )


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, n string, pos int, run long"


@pytest.mark.parametrize("count, sources", [(1, 1), (17, 1), (700, 4), (300, 300), (260, 17)])
def test_manifest_matches_a_plain_tree(spark, count, sources):
    rows = []
    for i in range(count):
        source = None if i % sources == 3 else f"s{(i % sources) if i % 3 else 0}é"
        text = [None, "", "ABC def É", "x" * 20_000, f"Text {i}"][i % 5]
        rows.append((i if i % 7 else None, source, "en" if i % 2 else None, i if i % 3 else None, text))
    rows += rows[:2] if count > 1 else []
    docs = spark.createDataFrame([(*r, "d", "n", 1, 2) for r in rows], SCHEMA)
    assert manifest_rows(docs) == plain_manifest(rows)


def test_manifest_without_rows(spark):
    assert manifest_rows(spark.createDataFrame([], SCHEMA)) == []


def plain_codes(vectors, parts=8, entries=16, rounds=6):
    """{row: (codes, error)}, codebooks; whole integer vectors in the order of their ids."""
    data = [[[v[p * len(v) // parts + j] for j in range((p + 1) * len(v) // parts - p * len(v) // parts)] for p in range(parts)] for v in vectors]
    books = [[list(row[p]) for row in data[:entries]] for p in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for row in data:
                mine.setdefault(best(row[p], books[p])[1], []).append(row[p])
            for i, rows in mine.items():
                books[p][i] = [sum(x) // len(rows) for x in zip(*rows, strict=True)]
    found = [[best(row[p], books[p]) for p in range(parts)] for row in data]
    return [([i for _, i in row], sum(d for d, _ in row)) for row in found], books


@pytest.mark.parametrize("count, width, distinct", [(5, 8, 5), (60, 16, 20), (120, 32, 120), (40, 20, 40)])
def test_codes_match_plain_rounds(spark, count, width, distinct):
    rng = np.random.default_rng(count)
    some = rng.normal(size=(distinct, width)).astype(np.float32)
    rows = [(i, some[i % distinct].tolist(), None if i % 3 == 0 else i % 2, 1, "c") for i in range(count)]
    odd = [(900, None, 1, 1, "c"), (901, [None] * width, 1, 1, "c"), (902, [float("nan")] * width, 1, 1, "c"),
           (903, [float("inf")] + [0.0] * (width - 1), None, 1, "c"), (904, [], 1, 1, "c"), (905, [1.0], 1, 1, "c")]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int, error int, codes string")
    codes, books = part_codes.compress(table)
    got = {r["vec_id"]: (list(r["codes"]), r["error"], r["label"], r["label_error"]) for r in part_codes.label_errors(codes).collect()}
    want, plain_books = plain_codes([[int(np.floor(np.float64(x) * 4096)) for x in v] for _, v, *_ in rows])
    assert [b.tolist() for b in books] == plain_books
    sums = {}
    for (_, _, label, *_), (_, error) in zip(rows, want, strict=True):
        sums[label] = sums.get(label, 0) + error
    assert got == {i: (*want[i], rows[i][2], sums[rows[i][2]]) for i in range(count)}
    decoded = part_codes.decode(codes, books).filter("vec_id = 0").first()
    assert decoded["vector"] == [x / 4096 for p, c in enumerate(decoded["codes"]) for x in plain_books[p][c]]


def test_large_subtrees_are_walked_alike(monkeypatch):
    rng = np.random.default_rng(3)
    parts, _ = part_codes.sorted_distinct(rng.integers(-3, 4, (3_000, 5)))
    entries = rng.integers(-3, 4, (16, 5))
    whole = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    for at_once in (1, 7, 8_192):
        monkeypatch.setattr(part_codes, "LEAVES_AT_ONCE", at_once)
        best, error = part_codes.nearest_entries(parts, entries)
        assert (best == whole.argmin(axis=1)).all() and (error == whole.min(axis=1)).all()


def test_equal_ids_and_empty_tables_of_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    codes, books = part_codes.compress(spark.createDataFrame([], schema))
    assert part_codes.label_errors(codes).count() == 0 and part_codes.codebooks_digest(books) == digest("")
    same = [(None, [float(i)] * 8, None) for i in range(3)] + [(1, [float(i)] * 8, 4) for i in range(3)]
    for order in itertools.islice(itertools.permutations(same), 0, 720, 300):
        codes, books = part_codes.compress(spark.createDataFrame(list(order), schema), entries=2)
        assert {tuple(b.ravel().tolist()) for b in books} == {tuple(books[0].ravel().tolist())}
        assert codes.agg(F.sum("error")).first()[0] == 8 * 2 * (2048 ** 2 + 2048 ** 2)


def test_too_large_components_are_refused(spark):
    table = spark.createDataFrame([(1, [1e9] * 8, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(OverflowError):
        part_codes.compress(table)
