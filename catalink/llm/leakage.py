"""Evaluation texts leaking into training text: a distributed positional inverted index.

The training texts are indexed once: every word of every document is stored as
positional postings, one row per word and block of documents, partitioned and
sorted by word. Test items are looked up in it: of every stretch of an item as
long as the shortest leak, the rarest words by document frequency are taken,
only their lists are read, and intersected with offsets adjusted (words of one
quotation agree on document position minus item position, up to the few words
that were put in or left out). Lists meet by block of documents and block of
items, so neither side has to be small. Where enough rare words agree, the
words around that offset are compared in order, as an exact phrase or nearly so.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalink.functions.kernels import Ragged
from catalink.sources.tables import broadcast_if_small, staged, stored_bytes

WORD = re.compile(r"[^\W_]+")
POSTINGS = "term long, block long, n_docs int, docs array<long>, times array<int>, positions array<int>"
#: Input partitions of the corpus whose postings of one word lie together.
SEGMENT = 8


@dataclass(frozen=True)
class Leak:
    """A leak is a chain of ``min_words`` or more words of the item in order,
    with at most ``skipped`` other words for each of them and at most ``gap`` in
    one place. ``rarest`` words of every stretch of ``min_words`` are looked up;
    ``hits`` of them must agree on their offset. Every chain has a stretch of
    which at most 4 words differ (with the defaults), so nothing is lost while
    ``hits`` is at most ``rarest`` - 4. ``block_words`` of documents and
    ``block_items`` items are intersected at a time."""

    min_words: int = 15
    skipped: float = 0.25
    gap: int = 2
    rarest: int = 10
    hits: int = 6
    block_words: int = 200_000
    block_items: int = 2_000

    @property
    def drift(self) -> int:
        """Most words by which offsets differ within the shortest chains."""
        return int(self.skipped * (2 * self.min_words - 1)) + 1


def words(text: str) -> list[str]:
    """Words in lower case: runs of letters and digits."""
    return WORD.findall(text.lower())


def word_hash(word: str) -> int:
    """64 bits, signed."""
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)


def _hashed(found: list[str]) -> np.ndarray:
    codes, distinct = pd.factorize(np.array(found, object))
    return np.fromiter(map(word_hash, distinct), np.int64, len(distinct))[codes] if found else np.empty(0, np.int64)


def _index_rows(block: int, docs: list[int], sizes: list[int], found: list[str]) -> pa.RecordBatch:
    """The postings of one block of documents, by word."""
    term = _hashed(found)
    doc = np.repeat(np.array(docs, np.int64), sizes)
    nth = np.repeat(np.arange(len(docs)), sizes)
    place = np.arange(len(term)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.argsort(term, kind="stable")
    term, doc, nth, place = term[order], doc[order], nth[order], place[order]
    new_term = np.concatenate([[True], term[1:] != term[:-1]]) if len(term) else np.empty(0, bool)
    new_doc = new_term | (np.concatenate([[True], nth[1:] != nth[:-1]]) if len(term) else new_term)
    at, runs = np.flatnonzero(new_term), np.flatnonzero(new_doc)
    times = np.diff(np.append(runs, len(term))).astype(np.int32)
    ends = np.append(np.searchsorted(runs, at), len(runs)).astype(np.int32)
    listed = lambda bounds, values: pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
    return pa.RecordBatch.from_arrays(
        [pa.array(term[at]), pa.array(np.full(len(at), block)), pa.array(np.diff(ends).astype(np.int32)), listed(ends, doc[runs]), listed(ends, times), listed(np.append(at, len(term)), place.astype(np.int32))],
        names=["term", "block", "n_docs", "docs", "times", "positions"],
    )


def build_index(documents: DataFrame, block_words: int = 200_000) -> DataFrame:
    """The postings of every word of every document, written once.

    ``term`` (hash of the word), ``block``, ``n_docs``, and of each document
    that holds the word in this block its id in ``docs``, how ``times`` often it
    stands there, and all ``positions``. Partitioned and sorted by word; a word
    that all documents hold is spread over segments of the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        docs, sizes, held = [], [], []
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = words(text)
                docs.append(doc)
                sizes.append(len(found))
                held += found
                if len(held) >= block_words:
                    yield _index_rows(block, docs, sizes, held)
                    block, docs, sizes, held = block + 1, [], [], []
        if held:
            yield _index_rows(block, docs, sizes, held)

    rows = documents.where("doc_id is not null and text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, POSTINGS)
    segment = F.shiftright("block", 32) / SEGMENT
    return staged(rows.repartition("term", segment.cast("long")).sortWithinPartitions("term", "block"), "postings")


def item_words(items: DataFrame, leak: Leak) -> DataFrame:
    """``item_id``, ``terms`` of the items that are long enough to leak."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            terms = [_hashed(words(t)) for t in b["item_text"]]
            yield pd.DataFrame({"item_id": b["item_id"], "terms": terms})

    rows = items.where("item_id is not null and item_text is not null").select(F.col("item_id").cast("long").alias("item_id"), "item_text").dropDuplicates(["item_id"])
    return staged(rows.mapInPandas(run, "item_id long, terms array<long>").where(F.size("terms") >= leak.min_words), "items")


def rarest_words(terms: np.ndarray, frequency: np.ndarray, leak: Leak) -> np.ndarray:
    """Positions of an item's words to look up: the rarest of every stretch.

    Words that no document holds are left out after the choice: they cannot be
    found, and count as differing.
    """
    stretches = np.lib.stride_tricks.sliding_window_view(np.arange(len(terms)), leak.min_words)
    order = np.argsort(frequency[stretches], axis=1, kind="stable")[:, : leak.rarest]
    chosen = np.unique(np.take_along_axis(stretches, order, 1))
    return chosen[frequency[chosen] > 0]


def looked_up(items: DataFrame, index: DataFrame, leak: Leak) -> DataFrame:
    """``term``, ``part`` (block of items), ``items``, ``places``: what to look up."""
    wanted = items.select("item_id", F.posexplode("terms").alias("pos", "term"))
    held = broadcast_if_small(wanted.select("term").distinct())
    df = index.select("term", "n_docs").join(held, "term").groupBy("term").agg(F.sum("n_docs").alias("df"))
    counted = wanted.join(df, "term", "left").groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("pos", "term", F.coalesce("df", F.lit(0)).alias("df")))).alias("x"))
    counted = counted.select("item_id", F.col("x.term").alias("terms"), F.col("x.df").alias("dfs"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            chosen = [rarest_words(np.asarray(t), np.asarray(d), leak) for t, d in zip(b["terms"], b["dfs"])]
            n = [len(c) for c in chosen]
            at = np.concatenate(chosen) if len(chosen) else np.empty(0, np.int64)
            term = np.concatenate([np.asarray(t)[c] for t, c in zip(b["terms"], chosen)]) if len(chosen) else at
            yield pd.DataFrame({"item_id": np.repeat(b["item_id"].to_numpy(), n), "pos": at, "term": term})

    parts = -(-items.count() // leak.block_items)
    rows = counted.mapInPandas(run, "item_id long, pos int, term long").withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(max(1, parts))))
    return rows.groupBy("term", "part").agg(F.collect_list(F.struct("item_id", "pos")).alias("x")).select("term", "part", F.col("x.item_id").alias("items"), F.col("x.pos").alias("places"))


def agreeing(item: np.ndarray, doc: np.ndarray, offset: np.ndarray, place: np.ndarray, leak: Leak) -> tuple[np.ndarray, ...]:
    """(document, item, offset) around which ``hits`` different words agree.

    Documents and items are small whole numbers from 0 on.
    """
    width = leak.drift
    low = offset.min()
    # one number for document, item, cell of offsets and place
    items, cells, places = int(item.max()) + 1, int((offset.max() - low) // width + 2), int(place.max()) + 1
    key = (doc * items + item) * cells + (offset - low) // width
    if (int(doc.max()) + 1) * items * cells * places < 1 << 63:
        both = key * places + place
        both.sort()
        key, place = both // places, both % places
    else:
        order = np.lexsort((place, key))
        key, place = key[order], place[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (place[1:] != place[:-1])])
    key, place = key[new], place[new]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    cell, n = key[first], np.diff(np.append(first, len(key)))
    # a cell and the next one hold every run of offsets no longer than one cell
    n[:-1] += np.where(cell[1:] == cell[:-1] + 1, n[1:], 0)
    enough = n >= leak.hits
    cell, first, n = cell[enough], first[enough], n[enough]
    # their words must stand within one stretch of the item
    which = np.repeat(np.arange(len(cell)), n)
    spot = place[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    order = np.lexsort((spot, which))
    which, spot = which[order], spot[order]
    new = np.concatenate([[True], (which[1:] != which[:-1]) | (spot[1:] != spot[:-1])]) if len(which) else np.empty(0, bool)
    which, spot = which[new], spot[new]
    h = leak.hits - 1
    near = (which[h:] == which[: len(which) - h]) & (spot[h:] - spot[: len(spot) - h] < leak.min_words)
    cell = cell[np.unique(which[: len(near)][near])]
    pair = cell // cells
    return pair // items, pair % items, cell % cells * width + low


def intersected(rows: pd.DataFrame, leak: Leak, at_once: int = 1_000_000) -> pd.DataFrame:
    """Candidates among one block of documents and one of items, a row per document."""
    times = [np.asarray(t, np.int64) for t in rows["times"]]
    doc = np.concatenate([np.repeat(np.asarray(d, np.int64), t) for d, t in zip(rows["docs"], times)])
    spot = np.concatenate([np.asarray(p, np.int64) for p in rows["positions"]])
    row = np.repeat(np.arange(len(rows)), [t.sum() for t in times])
    many = np.array([len(x) for x in rows["items"]])
    item, place = (np.concatenate([np.asarray(x, np.int64) for x in rows[c]]) for c in ("items", "places"))
    begin = np.cumsum(many) - many
    docs, doc = np.unique(doc, return_inverse=True)
    items, item = np.unique(item, return_inverse=True)
    order = np.argsort(doc, kind="stable")
    doc, spot, row = doc[order], spot[order], row[order]
    # cut between documents, so that not too many hits are held at once
    total = np.cumsum(many[row])
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    slot = (total[first] - many[row[first]]) // at_once
    cuts = np.append(first[np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))], len(doc))
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        n = many[row[a:b]]
        hit = np.repeat(begin[row[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out.append(agreeing(item[hit], np.repeat(doc[a:b] - doc[a], n), np.repeat(spot[a:b], n) - place[hit], place[hit], leak))
        out[-1] = (docs[out[-1][0] + doc[a]], items[out[-1][1]], out[-1][2])
    doc, item, offset = (np.concatenate(c) for c in zip(*out))
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.empty(0, np.int64)
    cut = lambda x: np.split(x, first[1:]) if len(x) else []
    return pd.DataFrame({"doc_id": doc[first], "items": cut(item), "offsets": cut(offset)})


def chains(items: Ragged, item: np.ndarray, docs: Ragged, doc: np.ndarray, offsets: np.ndarray, leak: Leak) -> tuple[np.ndarray, np.ndarray]:
    """Whether each candidate's document holds a leak of its item near the
    offset, and whether ``min_words`` of it stand there word for word.

    A candidate is one of ``items``, one of ``docs`` and an offset. Most have
    too few equal words there; the others are worked through together.
    """
    found, phrase = np.zeros(len(item), bool), np.zeros(len(item), bool)
    order = np.argsort(items.size[item], kind="stable")
    # all documents in a row, a zero behind each
    nth = np.repeat(np.arange(len(docs.size)), docs.size)
    flat = np.zeros(len(docs.flat) + len(docs.size) + 1, np.int64)
    flat[np.arange(len(docs.flat)) + nth + 1] = docs.flat
    begin = docs.begin + np.arange(len(docs.size)) + 1
    # items alike in length together, at most 20,000 words of them
    total = np.cumsum(items.size[item[order]])
    cuts = [0, *(np.flatnonzero(np.diff(total // 20_000)) + 1), len(order)]
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def settle() -> None:
        longest = max(e.shape[1] for _, e in held)
        rows = np.concatenate([r for r, _ in held])
        sure, exact = _fewest_skipped(np.concatenate([np.pad(e, ((0, 0), (0, longest - e.shape[1]), (0, 0))) for _, e in held]), leak)
        found[rows[sure]] = True
        phrase[rows[exact]] = True

    for part in (order[x:y] for x, y in zip(cuts[:-1], cuts[1:]) if x < y):
        sought = items.padded(item[part], int(items.size[item[part]].max()), 1)
        for rows, equal in _likely(sought, flat, begin[doc[part]], docs.size[doc[part]], offsets[part], leak):
            held.append((part[rows], equal))
            waiting += equal.shape[0] * equal.shape[1]
        if waiting > 100_000:
            settle()
            held, waiting = [], 0
    if held:
        settle()
    return found, phrase


def _likely(sought: np.ndarray, flat: np.ndarray, begin: np.ndarray, size: np.ndarray, offsets: np.ndarray, leak: Leak) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates with enough equal words: which ones, and for words of the item
    and offsets whether they are equal. A document lies at ``begin`` in ``flat``."""
    longest, most = sought.shape[1], 2 * leak.min_words - 1
    # the words that agree lie in two cells, those of their chain a drift beyond
    lead, band = leak.drift, 4 * leak.drift
    at = (np.arange(longest)[:, None] + np.arange(band)[None, :]).astype(np.int32)[None] + (offsets - lead).astype(np.int32)[:, None, None]
    np.clip(at, -1, size.astype(np.int32)[:, None, None], out=at)
    equal = flat[at + begin[:, None, None]] == sought[:, :, None]
    # the offsets of a chain lie within one drift, so in one of three narrower bands
    for first in range(0, band - leak.drift, leak.drift):
        part = equal[:, :, first : first + 2 * leak.drift]
        total = np.pad(np.cumsum(part.any(axis=2), axis=1), ((0, 0), (1, 0)))
        ahead = lambda n: (total[:, n:] - total[:, : longest + 1 - n]).max(axis=1, initial=0)  # noqa: E731, B023
        # too many other words in every stretch, or too few of the item's in any longer one
        rows = np.flatnonzero((ahead(leak.min_words) >= leak.min_words - leak.rarest + leak.hits) & (ahead(min(longest, most + leak.drift - 1)) >= leak.min_words))
        if len(rows):
            yield rows, part[rows]


def _fewest_skipped(equal: np.ndarray, leak: Leak) -> tuple[np.ndarray, np.ndarray]:
    """For candidates, words of the item and offsets: whether words are equal.

    For every pair of equal words, the fewest words skipped by a chain of k words
    that ends there. A long chain that keeps to both limits contains one of less
    than twice ``min_words`` that does, so k ends there.
    """
    none, most, band = np.int8(100), 2 * leak.min_words - 1, equal.shape[2]
    allowed = np.floor(leak.skipped * np.arange(1, most + 1)).astype(np.int8)
    allowed[: leak.min_words - 1] = -1
    found, phrase = np.zeros(len(equal), bool), np.zeros(len(equal), bool)
    rows: list[np.ndarray] = []
    for i in range(equal.shape[1]):
        row = np.full((len(equal), band, most), none)
        row[:, :, 0] = 0
        for di in range(1, min(leak.gap + 1, i) + 1):
            before = rows[-di]
            for dj in range(1, leak.gap + 2):
                s = di - dj
                a, b = max(0, -s), band - max(0, s)
                np.minimum(row[:, a:b, 1:], before[:, a + s : b + s, :-1] + np.int8(max(di, dj) - 1), out=row[:, a:b, 1:])
        row[~equal[:, i]] = none
        found |= (row <= allowed).any(axis=(1, 2))
        phrase |= (row[:, :, leak.min_words - 1] == 0).any(axis=1)
        rows = [*rows[-leak.gap :], row] if leak.gap else [row]
    return found, phrase


def matches(documents: DataFrame, items: DataFrame, leak: Leak = Leak(), index: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``item_id``, ``kind`` of every document that holds a leak of the item.

    ``kind`` is "phrase" where ``min_words`` words in a row are those of the
    item, else "near". ``documents`` has (``doc_id``, ``text``), ``items``
    (``item_id``, ``item_text``); ``index`` is that of ``build_index`` over the
    same documents, if there is one already. Null or empty texts leak nothing,
    items of fewer than ``min_words`` words cannot leak, repeated rows count
    once, empty tables give no rows; further columns are ignored. Texts of any
    length are searched whole.
    """
    index = build_index(documents, leak.block_words) if index is None else index
    sought = item_words(items, leak)
    asked = broadcast_if_small(looked_up(sought, index, leak))
    lists = index.drop("n_docs").join(asked, "term")
    near = lists.groupBy("block", "part").applyInPandas(lambda rows: intersected(rows, leak), "doc_id long, items array<long>, offsets array<long>")
    near = staged(near, "near")
    held = documents.where("text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pairs = held.join(broadcast_if_small(near), "doc_id")
    if stored_bytes(sought) <= 8 << 20 and sought.count() <= 50_000:
        # so few items that every worker can hold them: a text is sent once for all its candidates
        few = sorted((r["item_id"], r["terms"]) for r in sought.toLocalIterator())
        listed = Ragged.of_lists([t for _, t in few])
        # plain arrays, since workers have no copy of the package
        known = documents.sparkSession.sparkContext.broadcast((np.array([i for i, _ in few], np.int64), listed.flat, listed.size))
        pairs = pairs.select("doc_id", "text", "items", "offsets", F.lit(None).cast("array<long>").alias("terms"))
    else:
        known = None
        pairs = pairs.select("doc_id", "text", F.explode(F.arrays_zip("items", "offsets")).alias("x")).select("doc_id", "text", F.col("x.items").alias("item_id"), F.array("x.offsets").alias("offsets"))
        pairs = pairs.join(sought, "item_id").select("doc_id", "text", F.array("item_id").alias("items"), "offsets", "terms")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [words(t) for t in b["text"]]
            docs = Ragged(_hashed([w for x in found for w in x]), np.array([len(x) for x in found]))
            row = np.repeat(np.arange(len(b)), b["items"].map(len))
            item, offset = (np.concatenate([*b[c], np.empty(0)]).astype(np.int64) for c in ("items", "offsets"))
            if known:
                ids, flat, size = known.value
                terms, nth = Ragged(flat, size), np.searchsorted(ids, item)
            else:
                terms, nth = Ragged.of_lists(list(b["terms"])), row
            if len(item):
                sure, phrase = chains(terms, nth, docs, row, offset, leak)
                yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy()[row[sure]], "item_id": item[sure], "rank": (~phrase[sure]).astype("int32")})

    sure = pairs.mapInPandas(run, "doc_id long, item_id long, rank int").groupBy("doc_id", "item_id").agg(F.min("rank").alias("rank"))
    return sure.select("doc_id", "item_id", F.when(F.col("rank") == 0, "phrase").otherwise("near").alias("kind"))


def leaks(documents: DataFrame, items: DataFrame, leak: Leak = Leak()) -> DataFrame:
    """``doc_id``, ``item_id`` of ``matches``."""
    return matches(documents, items, leak).select("doc_id", "item_id")
