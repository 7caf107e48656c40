"""Long exact spans shared between records: difference-cover anchors.

Windows are hashed only at positions that fall on a difference cover modulo a
period. A cover has, for every shift, two members that far apart; so any two
texts that share a span of ``min_chars`` share a window of
``min_chars - period + 1`` characters that both texts anchored, whatever their
alignment. Anchors travel once, packed by ranges of their hash, and those that
a single text holds end there. Around the others the texts are compared: an
anchor of few texts pair by pair; one of many (a notice, a licence) by the
windows of ``min_chars`` that contain it, which makes no pairs: texts with an
equal window share a passage, and a passage lists its texts. Equal texts are
represented by one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalink.llm.components import components
from catalink.sources.tables import broadcast_if_small, staged

#: Characters that are hashed at a time.
SEGMENT = 1_000_000
#: Anchors that a map task sorts and sends together; equal ones of a batch beyond which they are spread.
BATCH, MANY = 500_000, 1_000
#: A perfect difference set modulo 133 (12 members).
COVER_133 = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
PACKED = "bucket int, hashes array<long>, docs array<long>, places array<long>"


@dataclass(frozen=True)
class Cover:
    """``few``: anchors of up to so many places are compared pair by pair."""

    period: int = 133
    members: tuple[int, ...] = COVER_133
    few: int = 64

    def __post_init__(self) -> None:
        if len({(a - b) % self.period for a in self.members for b in self.members}) != self.period:
            raise ValueError("not a difference cover: some shift has no two members")


BASE, OTHER_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def powers_of(base: int, n: int) -> np.ndarray:
    """1, base, base squared, ... modulo 2**64: ``n + 1`` of them."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


class Hasher:
    """64-bit hashes of windows: sums of codes times powers of an odd base,
    wrapping; dividing by the power at the window's begin makes them independent
    of the position."""

    def __init__(self, most: int, base: int = BASE) -> None:
        self.powers, self.back = powers_of(base, most), powers_of(pow(base, -1, 1 << 64), most)

    def __call__(self, codes: np.ndarray, width: int, at: np.ndarray) -> np.ndarray:
        n = len(codes)
        with np.errstate(over="ignore"):
            mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self.powers[:n], dtype=np.uint64)])
            h = (sums[at + width] - sums[at]) * self.back[at]
            h ^= h >> np.uint64(29)
            return (h * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _pieces(docs: list, texts: list[str], width: int) -> Iterator[tuple]:
    """Texts joined up to ``SEGMENT`` characters: codes, and for every piece its
    document, its begin in the codes, its length and its offset in the text.
    Longer texts are cut so that every window lies in one piece."""
    held, size = [], 0
    for doc, text in zip(docs, texts):
        for at in range(0, max(1, len(text) - width + 1), SEGMENT):
            part = text if len(text) <= SEGMENT + width - 1 else text[at : at + SEGMENT + width - 1]
            held.append((doc, part, at))
            size += len(part)
            if size >= SEGMENT:
                yield _joined(held)
                held, size = [], 0
            if part is text:
                break
    if held:
        yield _joined(held)


def _joined(held: list[tuple]) -> tuple:
    n = np.array([len(p) for _, p, _ in held])
    return _codes("".join(p for _, p, _ in held)), np.array([d for d, _, _ in held], np.int64), np.cumsum(n) - n, n, np.array([a for _, _, a in held])


def _packed(hashes: np.ndarray, docs: np.ndarray, places: np.ndarray, buckets: int, turn: int) -> pa.RecordBatch:
    """One row per range of hashes; of a hash that many places of the batch hold
    only two stay there, the others need no company to be known as shared."""
    order = np.lexsort((docs, hashes))
    h, d, p = hashes[order], docs[order], places[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    n = np.diff(np.append(first, len(h)))
    last = first + n - 1
    spread = np.repeat((n > MANY) & (d[first] != d[last]), n)
    spread[first] = spread[last] = False
    bucket = ((((h.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    bucket[spread] = buckets + turn % buckets
    order = np.argsort(bucket, kind="stable")
    bucket, h, d, p = bucket[order], h[order], d[order], p[order]
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends = pa.array(np.append(at, len(h)).astype(np.int32))
    listed = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (h, d, p)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[at].astype(np.int32)), *listed], names=["bucket", "hashes", "docs", "places"])


def _in_batches(parts: Iterator[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packs (hashes, docs, places) as they come."""
    held, rows, turn = [], 0, 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows >= BATCH:
            yield _packed(*(np.concatenate(c) for c in zip(*held)), buckets, turn)
            held, rows, turn = [], 0, turn + 1
    if rows:
        yield _packed(*(np.concatenate(c) for c in zip(*held)), buckets, turn)


def shared_hashes(packed: DataFrame, buckets: int, at_once: int = 4_000_000) -> DataFrame:
    """``hash``, ``doc_id``, ``place`` of the hashes that two documents or more hold.

    Every range of hashes meets in one place and is sorted there. Memory holds
    ``at_once`` hashes: hashes known as shared are written and leave it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        bucket, rows, known = None, 0, np.empty(0, np.int64)

        def settle() -> tuple[pa.RecordBatch, tuple]:
            h, d, p = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((d, h))
            h, d, p = h[order], d[order], p[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            n = np.diff(np.append(first, len(h)))
            shared = (d[first] != d[first + n - 1]) | np.isin(h[first], known)
            out = np.repeat(shared, n)
            return pa.RecordBatch.from_arrays([pa.array(h[out]), pa.array(d[out]), pa.array(p[out])], names=["hash", "doc_id", "place"]), (h[~out], d[~out], p[~out], h[first[shared]])

        for b in batches:
            for row in range(b.num_rows):
                here = b.column(0)[row].as_py()
                part = tuple(b.column(c)[row].values.to_numpy(zero_copy_only=False) for c in (1, 2, 3))
                if here >= buckets:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in part], names=["hash", "doc_id", "place"])
                    continue
                if here != bucket and rows:
                    yield settle()[0]
                if here != bucket:
                    bucket, held, rows, known = here, [], 0, np.empty(0, np.int64)
                held.append(part)
                rows += len(part[0])
                if rows > at_once:
                    done, (h, d, p, more) = settle()
                    yield done
                    held, rows, known = [(h, d, p)], 0, np.union1d(known, more)
        if rows:
            yield settle()[0]

    spread = packed.repartition(max(1, min(buckets, 100_000)), "bucket").sortWithinPartitions("bucket")
    return staged(spread.mapInArrow(run, "hash long, doc_id long, place long"), "shared")


def _anchors(min_chars: int, cover: Cover, buckets: int):
    """The function that hashes the windows on the cover of batches of texts."""
    width = min_chars - cover.period + 1
    on = np.zeros(cover.period, bool)
    on[list(cover.members)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hasher(2 * SEGMENT + 2 * width)

        def parts() -> Iterator[tuple]:
            for b in batches:
                for codes, docs, begin, n, offset in _pieces(b.column(0).to_pylist(), b.column(1).to_pylist(), width):
                    piece = np.repeat(np.arange(len(n)), n)
                    inside = np.arange(len(codes)) - begin[piece]
                    place = inside + offset[piece]
                    # the last windows of a cut piece begin the next one
                    at = np.flatnonzero(on[place % cover.period] & (inside <= n[piece] - width) & (inside < SEGMENT))
                    yield hashed(codes, width, at), docs[piece[at]], place[at]

        yield from _in_batches(parts(), buckets)

    return run


def _windows(min_chars: int, cover: Cover, buckets: int):
    """The function that hashes all windows of ``min_chars`` around hot anchors;
    a place holds the begin and, in its lower half, a second hash."""
    reach = cover.period - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, second = Hasher(2 * SEGMENT + 2 * min_chars), Hasher(2 * SEGMENT + 2 * min_chars, OTHER_BASE)

        def parts() -> Iterator[tuple]:
            for b in batches:
                for doc, text, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                    begins = places.values.to_numpy(zero_copy_only=False)
                    starts = np.unique((begins[:, None] - np.arange(reach + 1)[None, :]).ravel())
                    starts = starts[(starts >= 0) & (starts <= len(text) - min_chars)]
                    for at in range(0, len(text), SEGMENT):
                        s = starts[(starts >= at) & (starts < at + SEGMENT)]
                        if len(s):
                            codes = _codes(text[at : at + SEGMENT + min_chars])
                            low = second(codes, min_chars, s - at) & np.int64(0xFFFFFFFF)
                            yield hashed(codes, min_chars, s - at), np.full(len(s), doc), (s << np.int64(32)) | low

        yield from _in_batches(parts(), buckets)

    return run


def shared_spans(documents: DataFrame, min_chars: int = 300, cover: Cover = Cover(), chars: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Spans shared by different texts, as pairs and as passages.

    Pairs: ``rep_a`` < ``rep_b``, ``start_a``, ``start_b``, ``length``, one row
    for each anchor of few places whose extended span has ``min_chars``;
    ``length`` counts what lies within ``period - 1`` characters around the
    window, longer spans have several anchors. Passages: ``passage``,
    ``rep``, ``start`` of every window of ``min_chars`` that an anchor of many
    places lies in and that several texts hold. ``documents`` has one row per
    text (``doc_id``, ``text``); ``chars``: their characters in all.
    """
    if min_chars < 2 * cover.period:
        raise ValueError("min_chars must be twice the period or more")
    width, reach = min_chars - cover.period + 1, cover.period - 1
    texts = documents.select("doc_id", "text").where(F.length("text") >= min_chars)
    chars = texts.agg(F.sum(F.length("text"))).first()[0] if chars is None else chars
    least = 4 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-(chars or 0) * len(cover.members) // cover.period // 1_000_000))
    shared = shared_hashes(texts.mapInArrow(_anchors(min_chars, cover, buckets), PACKED), buckets)
    hot = shared.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > cover.few).select("hash", F.lit(True).alias("hot"))
    hot = staged(hot, "hot")
    any_hot = not hot.isEmpty()
    marked = shared.join(broadcast_if_small(hot), "hash", "left") if any_hot else shared.withColumn("hot", F.lit(None).cast("boolean"))
    marked = marked.groupBy("doc_id").agg(F.collect_list(F.when(F.col("hot").isNull(), F.struct("hash", "place"))).alias("few"), F.collect_list(F.when(F.col("hot"), F.col("place"))).alias("many"))
    marked = broadcast_if_small(marked)

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list[tuple] = []
            for doc, text, few in zip(b["doc_id"], b["text"], b["few"]):
                rows += [(x["hash"], doc, x["place"], text[max(0, x["place"] - reach) : x["place"]], text[x["place"] : x["place"] + width + reach]) for x in few]
            for k in range(0, len(rows) or 1, 10_000):
                yield pd.DataFrame(rows[k : k + 10_000], columns=["hash", "doc_id", "pos", "before", "body"])

    held = texts.join(marked, "doc_id")
    full = staged(held.where("size(few) > 0").select("doc_id", "text", "few").mapInPandas(around, "hash long, doc_id long, pos long, before string, body string"), "anchored")
    a, b = (full.select("hash", *(F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "pos", "before", "body"))) for s in "ab")

    def extended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            rows = []
            for da, db, pa_, pb, xa, xb, ya, yb in zip(p["doc_id_a"], p["doc_id_b"], p["pos_a"], p["pos_b"], p["before_a"], p["before_b"], p["body_a"], p["body_b"]):
                if ya[:width] != yb[:width]:
                    continue
                right = width + _common(ya[width:], yb[width:])
                left = _common(xa[::-1], xb[::-1])
                if left + right >= min_chars:
                    rows.append((da, db, pa_ - left, pb - left, left + right))
            yield pd.DataFrame(rows, columns=["rep_a", "rep_b", "start_a", "start_b", "length"])

    pairs = a.join(b, "hash").where("doc_id_a < doc_id_b").mapInPandas(extended, "rep_a long, rep_b long, start_a long, start_b long, length long")
    if any_hot:
        windows = held.where("size(many) > 0").select("doc_id", "text", "many").mapInArrow(_windows(min_chars, cover, buckets), PACKED)
        windows = shared_hashes(windows, buckets)
    else:
        windows = shared.where("false")
    # both hashes name the passage: a first one that meets by chance alone is parted again
    passages = windows.select(F.xxhash64("hash", F.col("place").bitwiseAND(0xFFFFFFFF)).alias("passage"), F.col("doc_id").alias("rep"), F.shiftright("place", 32).alias("start"))
    return pairs, passages


def _common(x: str, y: str) -> int:
    """Length of the common beginning."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        if x[:mid] == y[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _texts(documents: DataFrame, min_chars: int, least: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """``doc_id``, ``rep`` (the smallest id with exactly the same text) of the
    texts of ``least`` or ``min_chars``; the documents that are one of those and
    long enough; and their characters in all."""
    rows = documents.where(F.col("doc_id").isNotNull() & (F.length("text") >= (min_chars if least is None else least))).select("doc_id", F.xxhash64("text").alias("h1"), F.md5("text").alias("h2"), F.length("text").alias("n"))
    rows = staged(rows, "hashed")
    first = staged(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.first("n").alias("n")), "texts")
    copied = first.where("rep < last").select("h1", "h2", "rep")
    # most texts stand alone: only the copies are joined, and only they leave the table
    member = staged(rows.select("doc_id", "h1", "h2").join(broadcast_if_small(copied), ["h1", "h2"], "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep")).distinct(), "members")
    copies = broadcast_if_small(member.where("doc_id <> rep").select("doc_id"))
    kept = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.length("text") >= min_chars)).join(copies, "doc_id", "left_anti")
    if rows.count() > member.count():  # rows that stand twice under one id
        kept = kept.dropDuplicates(["doc_id"])
    return member, kept, first.agg(F.sum("n")).first()[0] or 0


def links(documents: DataFrame, min_chars: int = 300, cover: Cover = Cover()) -> tuple[DataFrame, DataFrame]:
    """Members (``doc_id``, ``rep``) and links (``rep_a``, ``rep_b``, ``passage``).

    A link without a passage joins two texts. The texts of a passage are all
    linked to each other; each has one row, from the smallest one to it. Windows
    that the same texts hold are one passage.
    """
    member, kept, chars = _texts(documents, min_chars)
    pairs, passages = shared_spans(kept, min_chars, cover, chars)
    direct = pairs.select("rep_a", "rep_b", F.lit(None).cast("long").alias("passage")).distinct()
    held = staged(passages.select("passage", "rep").distinct(), "held")
    sets = held.groupBy("passage").agg(F.min("rep").alias("rep_a"), F.max("rep").alias("_b"), F.expr("bit_xor(xxhash64(rep))").alias("_x"), F.expr("bit_xor(xxhash64(rep, 7))").alias("_y")).where("rep_a < _b")
    one = sets.groupBy("rep_a", "_x", "_y").agg(F.min("passage").alias("passage")).select("passage", "rep_a")
    through = held.join(one, "passage").where("rep_a < rep").select("rep_a", F.col("rep").alias("rep_b"), "passage")
    return member, staged(direct.unionByName(through), "links")


def members(documents: DataFrame, min_chars: int = 300, cover: Cover = Cover()) -> DataFrame:
    """One row per document of ``min_chars`` or more: ``doc_id``, ``rep`` (the
    smallest id of its copies), ``class_id`` (the smallest id linked to it,
    directly or through others) and ``n_links`` (rows of ``links`` it stands in)."""
    member, found = links(documents, min_chars, cover)
    groups = components(found, "rep_a", "rep_b").select(F.col("node").alias("rep"), F.col("component").alias("class_id"))
    ends = found.select(F.col("rep_b").alias("rep")).unionByName(found.where("passage is null").select(F.col("rep_a").alias("rep")))
    n = ends.groupBy("rep").agg(F.count("*").alias("n_links"))
    return member.join(groups, "rep", "left").join(n, "rep", "left").select("doc_id", "rep", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def shared_pairs(documents: DataFrame, min_chars: int = 300, cover: Cover = Cover()) -> DataFrame:
    """``doc_a`` < ``doc_b`` of every pair of documents that share a span.

    Null, empty and short texts share nothing, equal texts of ``min_chars`` or
    more share themselves, empty tables give no rows, other columns are
    ignored. Characters are code points. Spans are sought between
    representatives of equal texts and pairs come out for all their copies.
    """
    member, found = links(documents, min_chars, cover)
    of = found.where("passage is not null")
    of = of.select("passage", "rep_b").unionByName(of.select("passage", F.col("rep_a").alias("rep_b")).distinct())
    met = of.withColumnRenamed("rep_b", "rep_a").join(of, "passage").where("rep_a < rep_b").select("rep_a", "rep_b")
    every = staged(found.where("passage is null").select("rep_a", "rep_b").unionByName(met).distinct(), "pairs")
    a, b = (member.select(F.col("rep").alias(f"rep_{s}"), F.col("doc_id").alias(f"doc_{s}")) for s in "ab")
    across = every.join(a, "rep_a").join(b, "rep_b").select("doc_a", "doc_b")
    same = a.withColumnRenamed("rep_a", "rep").join(b.withColumnRenamed("rep_b", "rep"), "rep").where("doc_a < doc_b").select("doc_a", "doc_b")
    both = across.unionByName(same)
    return both.select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"))


def coverage(documents: DataFrame, min_chars: int = 300, cover: Cover = Cover()) -> DataFrame:
    """For every document how much of it is shared elsewhere.

    ``doc_id``, ``rep``, ``n_chars``, ``shared_chars`` (characters inside spans
    of ``min_chars`` or more that another text holds; all of them if an equal
    text exists) and ``shared_part``. One row per document, null texts with 0
    characters. The work is linear in the anchors.
    """
    member, kept, chars = _texts(documents, min_chars, 0)
    copies = member.groupBy("rep").agg(F.count("*").alias("copies"))
    spans, passages = shared_spans(kept, min_chars, cover, chars)
    several = passages.groupBy("passage").agg(F.min("rep").alias("_a"), F.max("rep").alias("_b")).where("_a < _b").select("passage")
    sides = [spans.select(F.col(f"rep_{s}").alias("rep"), F.col(f"start_{s}").alias("s"), (F.col(f"start_{s}") + F.col("length")).alias("e")) for s in "ab"]
    sides = sides[0].unionByName(sides[1]).unionByName(passages.join(several, "passage").select("rep", F.col("start").alias("s"), (F.col("start") + min_chars).alias("e")))
    # one interval per start, then the union: what each adds beyond all before it
    longest = sides.groupBy("rep", "s").agg(F.max("e").alias("e"))
    seen = F.max("e").over(Window.partitionBy("rep").orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    added = longest.withColumn("m", F.coalesce(seen, F.lit(0))).select("rep", F.greatest(F.lit(0), F.col("e") - F.greatest("s", "m")).alias("n"))
    covered = added.groupBy("rep").agg(F.sum("n").alias("covered"))
    rows = documents.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")).join(member, "doc_id", "left").join(copies, "rep", "left").join(covered, "rep", "left")
    shared = F.when((F.col("copies") > 1) & (F.col("n_chars") >= min_chars), F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0)))
    return rows.select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), "n_chars", shared.alias("shared_chars")).withColumn(
        "shared_part", F.when(F.col("n_chars") > 0, F.round(F.col("shared_chars") / F.col("n_chars"), 6)).otherwise(0.0)
    )
