"""Exact token counts at every prefix of a text, for byte-level BPE with word ends.

A prefix of a word ends in exactly one token that a token sequence can end in:
the one whose left neighbour, the last token of the shorter prefix, would not
have merged with it differently. So the counts of all prefixes of a word follow
from one another in a single pass, and no prefix is encoded by itself. Counts of
prefixes answer how many tokens a text has and where it must be cut to stay
within a budget without encoding anything again.

The tokenizer file is read on the driver, where its size is checked, and sent to
the tasks; its normalizer and word splitter run in the tokenizer library.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import text_or_empty

MODEL_BYTES = 64 << 20  # largest tokenizer file that is sent to the tasks
CACHED_WORDS = 400_000  # words whose counts a Python worker remembers
CACHED_PAIRS = 400_000


class PrefixCounter:
    """Counts of one tokenizer. ``model`` is the text of its .json file."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        described = json.loads(model)
        bpe = described["model"]
        ranks = [m if isinstance(m, list) else m.split(" ") for m in bpe["merges"]]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(ranks)}
        self.end = bpe.get("end_of_word_suffix") or ""
        tokens = set(bpe["vocab"])
        bodies = tokens | {t[: len(t) - len(self.end)] for t in tokens if self.end and t.endswith(self.end)}
        # by any beginning of a token: itself as a token that goes on, as one that ends a word, or None
        self.begins = {
            b: (b if b in tokens else None, b + self.end if b + self.end in tokens else None)
            for b in {t[:i] for t in bodies for i in range(1, len(t) + 1)}
        }
        self.parts: dict[str, tuple[int, str, str]] = {}
        if bpe.get("unk_token") or bpe.get("continuing_subword_prefix") or bpe.get("byte_fallback"):
            raise ValueError("only byte-level BPE without unknown tokens is supported")
        specials = described["added_tokens"]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in specials):
            raise ValueError("only added tokens that are matched as they stand are supported")
        names = sorted((t["content"] for t in specials), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        library = Tokenizer.from_str(model)
        self.normalize = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.pieces: dict[str, list[int]] = {}
        self.chunks: dict[str, int] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def _made_by(self, token: str) -> tuple[int, str, str]:
        """(rank, left, right) of the last merge that makes a token; rank -1 for a symbol."""
        known = self.parts.get(token)
        if known is None:
            body = token[: len(token) - len(self.end)] if self.end and token.endswith(self.end) else token
            symbols = [*body[:-1], body[-1:] + token[len(body):]]
            known = (-1, token, token)
            while len(symbols) > 1:
                rank, at = min(
                    (self.ranks.get(pair, _NEVER), i) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False))
                )
                known = (rank, symbols[at], symbols[at + 1])
                if rank == _NEVER:
                    break  # the vocabulary holds a token that no merge makes
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            self.parts[token] = known
        return known

    def _stay_apart(self, left: str, right: str) -> bool:
        """Do two tokens next to each other encode as just these two?

        Their merges are undone from the last to the first. At every point the
        pieces that touch must not have had a merge that comes before the one
        undone; of equal merges the one further left comes first.
        """
        a, b, limit = left, right, _NEVER
        while True:
            if self.ranks.get((a, b), _NEVER) < limit:
                return False
            (rank_a, _, inner_a), (rank_b, inner_b, _) = self._made_by(a), self._made_by(b)
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                a, limit = inner_a, rank_a
            else:
                b, limit = inner_b, rank_b + 1

    def word_prefixes(self, word: str) -> list[int]:
        """Token counts of all prefixes of one word, each taken as a word; words
        are in the byte alphabet of the tokenizer."""
        known = self.pieces.get(word)
        if known is not None:
            return known
        begins, pairs = self.begins.get, self.pairs
        n = len(word)
        last: list[str | None] = [None] * (n + 1)  # last token of a prefix that goes on
        going = [0] * (n + 1)
        counts = [0] * (n + 1)
        for j in range(n):
            before, so_far = last[j], going[j] + 1
            for i in range(j + 1, n + 1):
                found = begins(word[j:i])
                if found is None:
                    break
                token, ending = found
                if token is not None and last[i] is None:
                    if before is None:
                        fits = True
                    elif (fits := pairs.get((before, token))) is None:
                        fits = pairs[before, token] = self._stay_apart(before, token)
                    if fits:
                        last[i], going[i] = token, so_far
                if ending is not None and not counts[i]:
                    if before is None:
                        fits = True
                    elif (fits := pairs.get((before, ending))) is None:
                        fits = pairs[before, ending] = self._stay_apart(before, ending)
                    if fits:
                        counts[i] = so_far
        if len(pairs) >= CACHED_PAIRS:
            pairs.clear()
        if len(self.pieces) >= CACHED_WORDS:
            self.pieces.clear()
        self.pieces[word] = counts
        return counts

    def _learn(self, chunks: list[str]) -> dict[str, int]:
        """Tokens of stretches without white space, through one call of the library."""
        norm = self.normalize(" ".join(chunks))
        totals, at, stop = [0] * len(chunks), -1, -1
        for word, (start, _) in self.split(norm):
            while start >= stop:  # the next stretch begins after its blank
                at, stop = at + 1, norm.find(" ", stop + 1)
                stop = len(norm) + 1 if stop < 0 else stop
            totals[at] += self.word_prefixes(word)[-1]
        learnt = dict(zip(chunks, totals, strict=True))
        if len(self.chunks) + len(learnt) > CACHED_WORDS:
            self.chunks.clear()
        self.chunks.update(learnt)
        return learnt

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        total, at = 0, 0
        for found in [*(self.special.finditer(text) if self.special else ()), None]:
            stretch = text[at:found.start()] if found else text[at:]
            if _LOOSE.search(stretch):  # white space to str.split() alone
                total += self._ordinary(stretch)[1][-1]
            else:
                chunks = stretch.split()
                counts = list(map(self.chunks.get, chunks))
                if None in counts:
                    new = self._learn(list({c for c, n in zip(chunks, counts, strict=True) if n is None}))
                    counts = [new[c] if n is None else n for c, n in zip(chunks, counts, strict=True)]
                total += sum(counts)
            if found:
                total, at = total + 1, found.end()
        return total

    def _ordinary(self, stretch: str) -> tuple[str, list[int]]:
        norm = self.normalize(stretch)
        counts, total, at = [0], 0, 0
        for word, (start, stop) in self.split(norm):
            counts += [total] * (start - at)
            by_byte = self.word_prefixes(word)
            if len(word) > 2 and word[0] == "'":  # an unfinished contraction is split otherwise
                for n in range(2, len(word)):
                    by_byte = by_byte[:n] + [sum(self.word_prefixes(w)[-1] for w, _ in self.split(norm[start:start + n]))] + by_byte[n + 1:]
            ends = np.cumsum([len(c.encode()) for c in norm[start:stop]])
            counts += [total + by_byte[e] for e in ends]
            total, at = total + by_byte[-1], stop
        return norm, counts + [total] * (len(norm) - at)

    def prefixes(self, text: str) -> tuple[str, list[int]]:
        """(text as the tokenizer sees it, token counts of its prefixes by
        characters, the empty one first). A prefix that ends inside the name of
        a special token counts that part as ordinary text."""
        seen, counts, before, at = "", [0], 0, 0
        for found in [*(self.special.finditer(text) if self.special else ()), None]:
            stretch = text[at:found.start()] if found else text[at:]
            norm, inner = self._ordinary(stretch)
            seen += norm
            counts += [before + n for n in inner[1:]]
            before += inner[-1]
            if found:
                name, at = found.group(), found.end()
                _, inside = self._ordinary(stretch + name)
                counts += [before - inner[-1] + n for n in inside[len(norm) + 1:len(norm) + len(name)]]
                before += 1
                counts.append(before)
                seen += name
        return seen, counts


_NEVER = 1 << 60
_LOOSE = re.compile("[\x1c-\x1f]")
_counters: dict[str, PrefixCounter] = {}


def _counter(model: str) -> PrefixCounter:
    """One counter per worker process and tokenizer, with what it has learnt."""
    key = hashlib.md5(model.encode()).hexdigest()
    if key not in _counters:
        _counters.clear()
        _counters[key] = PrefixCounter(model)
    return _counters[key]


def _sent(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        model = file.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return docs.sparkSession.sparkContext.broadcast(model)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and n_tokens of every whole text.

    ``path`` names the tokenizer file on the driver. A null or empty text has no
    byte and no token. Every row is counted by itself, repeated rows and null
    ids too. Other columns are not looked at; an empty table stays empty.
    """
    model = _sent(docs, path)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(model.value)
        for texts in batches:
            yield pd.Series([counter.count(t) if t else 0 for t in texts], dtype="int64")

    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
        tokens(text).alias("n_tokens"),
    )


def store_prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``seen`` (the text as the tokenizer sees it) and ``counts``: the
    token count of the prefix of every length, from 0 on. Write it once and ask
    it with :func:`longest_prefix` and :func:`prefix_tokens`."""
    model = _sent(docs, path)

    @F.pandas_udf("seen string, counts array<int>")
    def prefixes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = _counter(model.value)
        for texts in batches:
            yield pd.DataFrame([counter.prefixes(t) for t in texts], columns=["seen", "counts"])

    made = docs.select(F.col(id_col).alias("doc_id"), prefixes(text_or_empty(text_col)).alias("p"))
    return made.select("doc_id", "p.seen", "p.counts")


def longest_prefix(stored: DataFrame, budget: int) -> DataFrame:
    """Add ``kept``, the longest prefix of no more than ``budget`` tokens."""
    places = F.filter(
        F.transform("counts", lambda n, i: F.when(n <= budget, i)), lambda i: i.isNotNull()
    )
    return stored.withColumn("kept", F.substring("seen", F.lit(1), F.array_max(places)))


def prefix_tokens(stored: DataFrame, characters: str) -> DataFrame:
    """Add ``tokens``: the count of the prefix as long as column ``characters`` says."""
    at = F.least(F.col(characters), F.size("counts") - 1)
    return stored.withColumn("tokens", F.get("counts", at.cast("int")))
