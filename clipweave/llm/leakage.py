"""Evaluation texts leaking into training text: q-gram filtering in diagonal bands, verified by banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave.llm import codes

#: Consecutive words of an item that make a leak; shorter items leak as a whole.
PASSAGE = 12
#: Letters of a q-gram.
Q = 10
#: Width of a band of diagonals; bands overlap by half.
BAND = 32
#: Letters of items that one pass over the documents looks for; more items take more passes. Bounds what a task is sent.
BLOCK_LETTERS = 4_000_000
#: Size of the table of q-grams that occur at all, as a power of two.
SIEVE = 22
#: Shared q-grams looked at together; texts and items that share more are taken piece by piece.
HITS_HELD = 4_000_000
#: Passages aligned together.
ALIGNED = 8_192


@dataclass
class ItemIndex:
    """The q-grams of a block of items, and what a leak of each must share."""

    ids: list
    words: codes.Words
    grams: np.ndarray  # sorted hashes
    at: np.ndarray  # position of each in the letters of all items
    sieve: np.ndarray
    first: np.ndarray  # first letter of each item
    needed: np.ndarray  # shared q-grams a leak of the item leaves at least
    size: np.ndarray  # words of a passage of each item
    passage: np.ndarray  # a hash of the passage that begins with each word of the items; only whole passages are looked up

    @classmethod
    def build(cls, ids: list, texts: list[str], edits: int) -> ItemIndex:
        w = codes.Words(texts)
        n = len(texts)
        hashes = letter_grams(w.chars, Q)
        inside = np.flatnonzero(w.char_text[: len(hashes)] == w.char_text[len(w.chars) - len(hashes) :]) if len(hashes) else np.zeros(0, np.int64)
        order = inside[np.argsort(hashes[inside], kind="stable")]
        sieve = np.zeros(1 << SIEVE, bool)
        sieve[(hashes[order] >> np.uint64(64 - SIEVE)).astype(np.int64)] = True
        # The fewest letters of PASSAGE consecutive words of each item, or of the whole item where it is shorter.
        counts = np.diff(w.bounds)
        span = np.minimum(counts, PASSAGE)
        least = np.zeros(n, np.int64)
        for i in range(n):
            a, b = w.bounds[i], w.bounds[i + 1]
            if b > a:
                s = w.starts[a : b + 1]
                least[i] = (s[span[i] :] - s[: len(s) - span[i]]).min()
        needed = least + 1 - Q - edits * Q
        word_hashes = w.hashes()
        passage = np.zeros(len(word_hashes), np.uint64)
        for size in sorted(set(span[span > 0].tolist())):
            runs = codes.runs_of(word_hashes, size)
            at = np.flatnonzero(span[w.text_of[: len(runs)]] == size)
            passage[at] = runs[at]
        return cls(ids, w, hashes[order], order, sieve, w.starts[w.bounds[:-1]], needed, span, passage)


def letter_grams(chars: np.ndarray, q: int) -> np.ndarray:
    """A hash of every q consecutive letters."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(q):
        out *= np.uint64(0x100000001B3)
        out += chars[i : n + i]
    return codes.mix(out)


def shared_grams(index: ItemIndex, w: codes.Words, held: int = HITS_HELD) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, item, diagonal, letter of the item) of every q-gram that a text shares with an item, about `held` at a time.

    The diagonal counts from the text's and the item's own first letters.
    """
    grams = letter_grams(w.chars, Q)
    maybe = np.flatnonzero(index.sieve[(grams >> np.uint64(64 - SIEVE)).astype(np.int64)])
    maybe = maybe[w.char_text[maybe] == w.char_text[maybe + Q - 1]]
    first = np.searchsorted(index.grams, grams[maybe], "left")
    times = np.searchsorted(index.grams, grams[maybe], "right") - first
    maybe, first, times = maybe[times > 0], first[times > 0], times[times > 0]
    begin = w.starts[w.bounds[:-1]]
    upto = np.cumsum(times)
    edges = np.unique(np.append(np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, held), "right"), len(times)))
    for a, b in zip(np.append(0, edges[:-1]), edges):
        n = times[a:b]
        if not len(n):
            continue
        hit = index.at[np.repeat(first[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        where = np.repeat(maybe[a:b], n)
        text, item = w.char_text[where].astype(np.int64), index.words.char_text[hit].astype(np.int64)
        place = hit - index.first[item]
        yield text, item, where - begin[text] - place, place


def _regions(text: np.ndarray, item: np.ndarray, diagonal: np.ndarray, shift: int, items: int) -> np.ndarray:
    """One number for the text, the item and the band of every diagonal, the bands beginning `shift` further in front."""
    return (text * items + item << 24) + (diagonal + shift) // BAND + (1 << 23)


def candidate_passages(index: ItemIndex, w: codes.Words, edits: int) -> np.ndarray:
    """Rows (text, item, first word, lowest diagonal) of the passages whose alignment in a band is worth trying.

    In every band the q-grams shared with an item are counted. A region is retained if it has as many as the shortest
    passage of the item leaves within the edit budget, and of its passages those with as many as they leave themselves.
    Where the budget leaves none for sure, one shared q-gram is asked for. Items shorter than a q-gram are handled by
    `short_matches`.
    """
    items, iw, out = len(index.ids), index.words, []
    for shift in (0, BAND // 2):
        counted: list[tuple[np.ndarray, np.ndarray]] = []
        for text, item, diagonal, _ in shared_grams(index, w):
            counted.append(np.unique(_regions(text, item, diagonal, shift, items), return_counts=True))
        if not counted:
            continue
        region, at = np.unique(np.concatenate([r for r, _ in counted]), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate([c for _, c in counted]))
        kept = region[count >= np.maximum(index.needed[(region >> 24) % items], 1)]
        if not len(kept):
            continue
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for text, item, diagonal, place in shared_grams(index, w):
            r = _regions(text, item, diagonal, shift, items)
            known = np.minimum(np.searchsorted(kept, r), len(kept) - 1)
            ok = kept[known] == r
            found.append((known[ok], place[ok]))
        known, place = (np.concatenate(f) for f in zip(*found))
        order = np.lexsort((place, known))
        known, place = known[order], place[order]
        edges = np.searchsorted(known, np.arange(len(kept) + 1))
        for k, r in enumerate(kept.tolist()):
            item = (r >> 24) % items
            places = np.unique(place[edges[k] : edges[k + 1]])
            a, b, size = int(iw.bounds[item]), int(iw.bounds[item + 1]), int(index.size[item])
            starts = iw.starts[a : b + 1] - index.first[item]
            low, high = starts[: len(starts) - size], starts[size:]
            shared = np.searchsorted(places, high - Q, "right") - np.searchsorted(places, low, "left")
            s = np.flatnonzero(shared >= np.maximum(high - low + 1 - Q - edits * Q, 1))
            line = ((r & (1 << 24) - 1) - (1 << 23)) * BAND - shift
            out.append(np.stack([np.full(len(s), (r >> 24) // items), np.full(len(s), item), s + a, np.full(len(s), line)], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


def aligned(index: ItemIndex, w: codes.Words, passages: np.ndarray, edits: int) -> np.ndarray:
    """Whether each passage turns into some piece of its text, on diagonals of its band, by at most `edits` edits.

    Banded alignment of many passages at once, letter by letter of the passages; a row holds the least edits by diagonal.
    Passages whose rows all exceed the budget are dropped on the way.
    """
    iw = index.words
    out = np.zeros(len(passages), bool)
    width, far = BAND + 2 * edits, edits + 1
    step = np.arange(width)
    for s in range(0, len(passages), ALIGNED):
        text, item, word, low = passages[s : s + ALIGNED].T
        first, length = iw.starts[word], iw.starts[word + index.size[item]] - iw.starts[word]
        begin, end = w.starts[w.bounds[text]], w.starts[w.bounds[text + 1]]
        # The place in all letters before which the passage's first letter stands, by diagonal.
        at = (begin + low - edits + first - index.first[item])[:, None] + step
        row = np.where((at >= begin[:, None]) & (at <= end[:, None]), 0, far).astype(np.int32)
        open_ = np.arange(len(text))
        for r in range(int(length.max(initial=0))):
            here = at[open_] + r
            inside = (here >= begin[open_, None]) & (here < end[open_, None])
            same = inside & (w.chars[np.clip(here, 0, len(w.chars) - 1)] == iw.chars[first[open_] + r][:, None])
            skip = np.concatenate([row[:, 1:], np.full((len(row), 1), far, np.int32)], axis=1) + 1  # a letter the text lacks
            new = np.minimum(row + ~same, skip)
            new[(here + 1 < begin[open_, None]) | (here + 1 > end[open_, None])] = far
            row = np.minimum(np.minimum.accumulate(new - step, axis=1) + step, far)  # letters the passage lacks
            good = row.min(axis=1) <= edits
            done = good & (length[open_] == r + 1)
            out[s + open_[done]] = True
            go = good & ~done
            open_, row = open_[go], row[go]
            if not len(open_):
                break
    return out


def leaks_in(index: ItemIndex, texts: list[str], edits: int = 0) -> list[tuple[int, int]]:
    """(text, item) numbers of the leaks in a batch of texts.

    Without edits the passages that align letter by letter are checked word by word after: a leak has whole words.
    """
    w = codes.Words(texts)
    if not len(w.chars) or not len(index.words.chars):
        return []
    word_hashes = w.hashes()
    passages = candidate_passages(index, w, edits)
    passages = passages[aligned(index, w, passages, edits)]
    if not edits and len(passages):
        same = np.zeros(len(passages), bool)
        for text in np.unique(passages[:, 0]).tolist():
            own = word_hashes[w.bounds[text] : w.bounds[text + 1]]
            at = np.flatnonzero(passages[:, 0] == text)
            sizes = index.size[passages[at, 1]]
            for size in np.unique(sizes).tolist():
                of = at[sizes == size]
                same[of] = np.isin(index.passage[passages[of, 2]], codes.runs_of(own, size))
        passages = passages[same]
    found = set(map(tuple, np.unique(passages[:, :2], axis=0).tolist()))
    found.update(short_matches(index, w, word_hashes))
    return sorted(found)


def short_matches(index: ItemIndex, w: codes.Words, word_hashes: np.ndarray) -> set[tuple[int, int]]:
    """Leaks of items with fewer letters than a q-gram, by the hashes of all their words."""
    iw, found = index.words, set()
    letters = iw.starts[iw.bounds[1:]] - iw.starts[iw.bounds[:-1]]
    for b in np.flatnonzero((letters < Q) & (letters > 0)).tolist():
        own = iw.hashes()[iw.bounds[b] : iw.bounds[b + 1]]
        runs = codes.runs_of(word_hashes, len(own))
        at = np.flatnonzero(runs == codes.runs_of(own, len(own))[0])
        at = at[w.text_of[at] == w.text_of[at + len(own) - 1]]
        found.update((int(t), b) for t in w.text_of[at])
    return found


def leaks(documents: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", edits: int = 0) -> DataFrame:
    """(`key`, `item`) of every document with at least PASSAGE consecutive words of an item, or the whole of a shorter one.

    Case, punctuation, vowel marks, bracket tags, characters without a glyph and the kind and number of blanks are
    ignored. With `edits` above 0 a passage may differ in so many letters, and whole-word bounds are not asked for.
    Items are taken in blocks of BLOCK_LETTERS, each block in one pass over whole documents without any shuffle of
    text. Null keys, null and empty texts and items without a letter match nothing; repeated rows
    count once.
    """
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((documents, key), (items, item))}
    given = items.where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).groupBy(item).agg(F.max(item_text).alias("text"))
    total = given.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_LETTERS))
    out = None
    for k in range(blocks):
        block = given.where(F.pmod(F.xxhash64(item), F.lit(blocks)) == k).orderBy(item).collect()  # bounded by BLOCK_LETTERS
        ids, texts = [r[item] for r in block], [r["text"] for r in block]

        def run(batches: Iterator[pa.RecordBatch], ids: list = ids, texts: list = texts) -> Iterator[pa.RecordBatch]:
            index = ItemIndex.build(ids, texts, edits)
            kind = pa.array(ids).type if ids else pa.null()
            for batch in batches:
                found = leaks_in(index, [t or "" for t in batch.column(1).to_pylist()], edits)
                t, i = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(t, pa.int32())), pa.array([ids[x] for x in i], kind if ids else pa.int64())], names=[key, item]
                )

        part = documents.where(F.col(key).isNotNull()).select(key, text).mapInArrow(run, f"`{key}` {kinds[key]}, `{item}` {kinds[item]}")
        out = part if out is None else out.unionByName(part)
    return out.distinct()
