"""Visually identical text with different characters, brought to one form."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.session import cut

# Letters of one script that look the same where they join, or that only phonetic writing has, each with the
# usual one. Look-alikes of other scripts come from the public table of confusable characters, see `other_scripts`.
LOOK_ALIKES = "کك یي ەه ɡg ɑa"
#: Kinds of compatibility characters that differ from their plain form only in width, joining or breaking.
SAME_LOOK = {"<wide>", "<narrow>", "<initial>", "<medial>", "<final>", "<isolated>", "<noBreak>"}
#: Word classes in the tries, the most frequent first; the rest is normalised by table. Bounds what every task is sent.
VOCABULARY = 20_000
#: Distinct tokens counted or remembered by one task before it passes them on or starts anew.
TOKENS_HELD = 200_000
BLANKS = re.compile(r"\s+")


def other_scripts(spark: SparkSession) -> dict[str, str]:
    """Letters of other scripts that look like an ASCII letter, with that letter: about 160.

    They are read from the table of confusable characters that Unicode publishes, which the ICU library of every Spark
    session holds. Capital and small letters and letters without case are kept apart, and so are letters of one script, which its readers tell apart.
    """
    letters = [chr(c) for c in range(0x20000) if unicodedata.category(chr(c)) in ("Lu", "Ll", "Lo") and not unicodedata.decomposition(chr(c))]
    checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    skeletons = checker.getSkeleton("\n".join(letters)).split("\n")
    plain = {(s, unicodedata.category(x)): x for x, s in zip(letters, skeletons) if x.isascii()}
    found = ((x, plain.get((s, unicodedata.category(x)))) for x, s in zip(letters, skeletons))
    return {x: to for x, to in found if to and x != to and not unicodedata.name(x, "").startswith("LATIN")}


class Looks:
    """How characters look: which have no glyph, and which look like another."""

    def __init__(self, alike: dict[str, str] | None = None):
        self.alike = (alike or {}) | {a: b for a, b in LOOK_ALIKES.split()}
        #: Every code point whose plain form differs: look-alikes, widths, presentation forms; "" if it has no glyph.
        self.table: dict[int, str] = dict(_shapes())
        for a, b in self.alike.items():
            self.table[ord(a)] = b
        for c, form in list(self.table.items()):  # a fullwidth or presentation form of a character that is itself in the table
            self.table[c] = "".join(self.table.get(ord(x), x) for x in form)
        self.apart = {c: unicodedata.normalize("NFD", form) for c, form in self.table.items()}
        # Characters without a glyph go before tokens are told apart: one alone between two blanks isn't a token.
        self.blanks = {c: form for c, form in self.table.items() if form in ("", " ")}

    def __reduce__(self):
        return Looks, (self.alike,)

    def fold(self, text: str) -> str:
        """The table's form: composed letters are taken apart first so that every part is looked up, and put together after."""
        if text.isascii():
            return text
        apart = unicodedata.normalize("NFD", text).translate(self.table)
        return unicodedata.normalize("NFC", apart.translate(self.table))

    def parts(self, character: str) -> str:
        """What a character shows: nothing, itself, or the plain characters it looks like, composed letters taken apart."""
        return self.apart.get(ord(character), character)


@cache
def _shapes() -> dict[int, str]:
    """Blanks, characters without a glyph, and compatibility forms that differ in width, joining or breaking, by Unicode's own properties."""
    table: dict[int, str] = {}
    for c in range(0x20000):
        ch = chr(c)
        kind = unicodedata.category(ch)
        if kind == "Zs":
            table[c] = " "
        elif kind == "Cf" or (kind == "Cc" and not ch.isspace()) or 0xFE00 <= c < 0xFE10 or c in (0x034F, 0x115F, 0x1160, 0x3164, 0xFFA0):
            table[c] = ""
        else:
            parts = unicodedata.decomposition(ch).split()
            if parts and (parts[0] in SAME_LOOK or 0xFB00 <= c <= 0xFB06):
                table[c] = "".join(chr(int(p, 16)) for p in parts[1:])
    return table


#: Costs of the edit automaton. A look-alike and a character without a glyph can't be seen, so they are free; every letter
#: that is missing, added or another one, a mark, a dot or the case costs as much as shows of it.
FREE, MARK, LETTER = 0.0, 0.5, 1.0


class WordTries:
    """A trie of words in the spelling they were given, walked by a weighted edit automaton.

    A token is read character by character, composed letters as their parts. A character without a glyph moves no state
    and costs nothing; any other goes along every edge whose label looks the same, at no cost, whichever of the look-alikes
    the word is spelt with. Below the budget it may also be passed over, stand for a label that looks otherwise, or labels
    may be passed over; that costs MARK for marks and LETTER for anything else. Labels without a glyph are passed over
    at no cost. So several states are alive at a time, each with the least cost to reach it.
    """

    def __init__(self, words: Iterable[str], looks: Looks):
        self.looks = looks
        self.nodes: list[dict[str, list[tuple[str, int]]]] = [{}]  # of a node the labels by what they show, with their nodes
        self.ends: dict[int, str] = {}
        for word in words:
            node = 0
            for label in unicodedata.normalize("NFD", word):
                for shown in looks.parts(label) or [""]:
                    edges = self.nodes[node].setdefault(shown, [])
                    node = next((n for x, n in edges if x == label), -1)
                    if node < 0:
                        node = len(self.nodes)
                        self.nodes.append({})
                        edges.append((label, node))
            self.ends.setdefault(node, word)

    def match(self, token: str, budget: float = FREE) -> tuple[str, float] | None:
        """(word, cost) of the word that costs least to reach within `budget`, the smaller one on ties; None if there is none."""
        active = self._closed({0: FREE}, budget)
        for character in unicodedata.normalize("NFD", token):
            for shown in self.looks.parts(character):
                active = self._closed(self._read(active, shown, budget), budget)
                if not active:
                    return None
        found = [(cost, self.ends[n]) for n, cost in active.items() if n in self.ends]
        return min(found)[::-1] if found else None

    def _read(self, active: dict[int, float], shown: str, budget: float) -> dict[int, float]:
        """The states after one more plain character."""
        out: dict[int, float] = {}

        def reach(node: int, cost: float) -> None:
            if cost <= budget and cost < out.get(node, budget + LETTER):
                out[node] = cost

        added = MARK if unicodedata.combining(shown) else LETTER
        for node, cost in active.items():
            for _, child in self.nodes[node].get(shown, ()):
                reach(child, cost)
            if cost + MARK <= budget:
                reach(node, cost + added)
                for edges in self.nodes[node].values():
                    for _, child in edges:
                        reach(child, cost + LETTER)
        return out

    def _closed(self, active: dict[int, float], budget: float) -> dict[int, float]:
        """Also the states reached by passing labels over: free where they have no glyph, else as far as the budget allows."""
        todo = [(n, c) for n, c in active.items() if "" in self.nodes[n] or c + MARK <= budget]
        while todo:
            node, cost = todo.pop()
            for form, edges in self.nodes[node].items():
                step = FREE if not form else MARK if unicodedata.combining(form) else LETTER
                for _, child in edges:
                    if cost + step <= budget and cost + step < active.get(child, budget + LETTER):
                        active[child] = cost + step
                        todo.append((child, cost + step))
        return active


def _tokens(text: str, looks: Looks) -> tuple[list[str], list[str]]:
    """Tokens of a text and the blanks between them, each run as one blank or one line break. Blanks of any width are blanks."""
    spread = text if text.isascii() else text.translate(looks.blanks)
    spread = spread.strip()
    tokens = spread.split()
    if "\n" in spread or "\r" in spread:
        gaps = ["\n" if ("\n" in g or "\r" in g) else " " for g in BLANKS.findall(spread)]
    else:
        gaps = [" "] * (len(tokens) - 1)
    return tokens, gaps


class Canonical:
    """Canonical form of texts: words of the tries in their chosen spelling, others by table."""

    def __init__(self, words: Iterable[str], looks: Looks):
        self.looks = looks
        self.tries = WordTries(words, looks)
        self.memory: dict[str, str] = {}

    def __call__(self, text: str) -> str:
        tokens, gaps = _tokens(text, self.looks)
        memory, out = self.memory, []
        for t in tokens:
            form = memory.get(t)
            if form is None:
                if len(memory) >= TOKENS_HELD:
                    memory.clear()
                form = memory[t] = self.word(t)
            out.append(form)
        if "\n" not in gaps:
            return " ".join(out)
        return "".join(x for pair in zip(out, [*gaps, ""]) for x in pair)

    def word(self, token: str) -> str:
        """The chosen spelling of a token; the table's, if no word of the tries looks the same.

        The table also puts marks in order, so its form is looked for once more.
        """
        found = self.tries.match(token)
        if found is None:
            folded = self.looks.fold(token)
            found = self.tries.match(folded) if folded != token else None
            return found[0] if found else folded
        return found[0]


def vocabulary(texts: DataFrame, columns: list[str], looks: Looks, size: int = VOCABULARY) -> list[str]:
    """Canonical spellings of the `size` most frequent classes of equal-looking tokens.

    Of a class the spelling found most often wins that is composed and free of characters without a glyph; a class
    without such a spelling is left to the table. Counted over all rows; only the chosen words come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            words = list(held)
            forms = [looks.fold(w) for w in words]
            clean = [f == w or (unicodedata.is_normalized("NFC", w) and not any(looks.parts(c) == "" for c in w)) for f, w in zip(forms, words)]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(forms, pa.string()), pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64()), pa.array(clean, pa.bool_())],
                names=["class", "word", "n", "clean"],
            )
            held.clear()
            return batch

        for batch in batches:
            for i in range(batch.num_columns):
                for text in batch.column(i).to_pylist():
                    if text:
                        held.update(_tokens(text, looks)[0])
            if len(held) >= TOKENS_HELD:
                yield flush()
        yield flush()

    counted = texts.select(*columns).mapInArrow(count, "class string, word string, n bigint, clean boolean")
    counted = counted.groupBy("class", "word", "clean").agg(F.sum("n").alias("n"))
    # The table's own spelling wins ties, so that a spelling is only kept where the corpus prefers it.
    best = F.max_by("word", F.struct("clean", "n", (F.col("word") == F.col("class")).alias("plain"), "word"))
    classes = counted.groupBy("class").agg(F.sum("n").alias("n"), best.alias("word"), F.max("clean").alias("clean"))
    top = classes.where("clean").orderBy(F.desc("n"), "class").limit(size)
    return [r["word"] for r in top.select("word").collect()]


def canonical_texts(texts: DataFrame, columns: list[str], *, key: str = "id", size: int = VOCABULARY) -> DataFrame:
    """(`key`, field, text, canonical, form, raw) for every non-empty value of `columns`, a row per field.

    Two values look alike if and only if their `canonical` is equal; `form` and `raw` are 128-bit hashes of the canonical
    and of the given characters, for joins. Null and empty values are left out; so are values of nothing but characters
    without a glyph, which show nothing. Extra columns are ignored; an empty table gives an empty result.
    """
    looks = Looks(other_scripts(texts.sparkSession))
    words = vocabulary(texts, columns, looks, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical(words, looks)
        for batch in batches:
            keys = batch.column(0)
            for i, name in enumerate(columns, 1):
                values = batch.column(i).to_pylist()
                at = [j for j, v in enumerate(values) if v]
                given = [values[j] for j in at]
                forms = [canonical(v) for v in given]
                shown = [j for j, f in enumerate(forms) if f]
                if len(shown) < len(forms):
                    at, given, forms = ([x[j] for j in shown] for x in (at, given, forms))
                hashes = [[hashlib.blake2b(v.encode("utf-8", "surrogatepass"), digest_size=16).digest() for v in vs] for vs in (forms, given)]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at, pa.int32())), pa.array([name] * len(at), pa.string()), pa.array(given, pa.string()), pa.array(forms, pa.string()), *[pa.array(h, pa.binary()) for h in hashes]],
                    names=[key, "field", "text", "canonical", "form", "raw"],
                )

    kind = texts.schema[key].dataType.simpleString()
    return texts.select(key, *columns).mapInArrow(run, f"`{key}` {kind}, field string, text string, canonical string, form binary, raw binary")


def _spellings(canonical: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows, spellings): one row (`key`, field, form, raw) each, and (field, form, raw, rows) of the forms that are spelt in several ways."""
    rows = cut(canonical.where(F.col(key).isNotNull()).groupBy(key, "field", "form", "raw").agg(F.lit(1).alias("one")).drop("one"), "alike")
    spelt = rows.groupBy("field", "form", "raw").agg(F.count("*").alias("rows"))
    several = spelt.groupBy("field", "form").agg(F.count("*").alias("n")).where("n > 1").select("field", "form")
    return rows, cut(spelt.join(several, ["field", "form"], "left_semi"), "alike-spelt")


def alike_pairs(canonical: DataFrame, *, key: str = "id") -> DataFrame:
    """(`key`_a, `key`_b) of rows, a < b, one field of which looks the same but has other characters.

    Spellings are paired first, one row each; only pairs of different spellings are joined with the rows that have them. So
    a text that a third of all rows share is never paired with itself, and every joined pair is a result. Where a pair
    of common spellings makes too many, `alike_classes` says the same in a row per record. Repeated rows of a key count once.
    """
    rows, spelt = _spellings(canonical, key)
    a, b = (spelt.select("field", "form", F.col("raw").alias(f"raw_{x}")) for x in "ab")
    unlike = a.join(b, ["field", "form"]).where("raw_a < raw_b").select("field", "raw_a", "raw_b")
    for x in "ab":
        unlike = unlike.join(rows.select("field", F.col("raw").alias(f"raw_{x}"), F.col(key).alias(f"_{x}")), ["field", f"raw_{x}"])
    pairs = unlike.where("_a <> _b").select(F.least("_a", "_b").alias(f"{key}_a"), F.greatest("_a", "_b").alias(f"{key}_b"))
    return pairs.distinct()


def alike_classes(canonical: DataFrame, *, key: str = "id") -> DataFrame:
    """(`key`, field, class, links) of every row whose text is also spelt otherwise: what it looks like, as a number in hexadecimal
    digits, and how many rows of the same look have other characters."""
    rows, spelt = _spellings(canonical, key)
    total = spelt.groupBy("field", "form").agg(F.sum("rows").alias("all"))
    linked = spelt.join(total, ["field", "form"]).select("field", "form", "raw", (F.col("all") - F.col("rows")).alias("links"))
    return rows.join(linked, ["field", "form", "raw"]).select(key, "field", F.lower(F.hex("form")).alias("class"), "links")
