"""Candidate join: an inverted index of title words and a ranked top k.

Scores are BM25 with statistics over the whole right side; the result is exactly
the top k. The right side is dealt out to parts of so many postings, and one
part after the other is sent to the workers, which look the left records up in
it: nothing but the best of each part is written. A right record is scored if the
words that it shares can reach what the best k have. Which do is told by lists
of the records of every two words, and by bits of the commonest words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalink.functions.text import search_terms
from catalink.sources.tables import staged

K1, B = 1.2, 0.75
#: Words of more than one in COMMON records are not looked up, of BITS of them each record has a bit; records of more than
#: WIDE other words are always looked at; bounds are whole numbers of a UNIT.
COMMON, BITS, WIDE, UNIT = 8, 12, 24, 1 << 14


def index(df: DataFrame, key: str, text: str) -> DataFrame:
    """Postings (``key``, ``term``, ``tf``, ``dl``) of a column."""
    terms = df.select(F.col(key).alias("key"), search_terms(F.col(text)).alias("t")).where(F.size("t") > 0)
    return terms.select("key", F.size("t").alias("dl"), F.explode("t").alias("term")).groupBy("key", "term", "dl").agg(F.count("*").alias("tf"))


def _weight(n: Column, average: Column) -> Column:
    idf = F.log(1.0 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / average))


class Part:
    """Postings (``term``, ``row`` from 0 on, ``weight``), sorted by row and term, made for lookups."""

    def __init__(self, term: np.ndarray, row: np.ndarray, weight: np.ndarray) -> None:
        self.n, self.weight = int(row[-1]) + 1, weight
        self.begin = np.append(0, np.cumsum(np.bincount(row)))
        self.terms, number = np.unique(term, return_inverse=True)
        self.term, df = number.astype(np.int32), np.bincount(number)
        order = np.argsort(number, kind="stable")
        self.rows, self.weights, self.lists = row[order].astype(np.int32), weight[order], np.append(0, np.cumsum(df))
        self.top = np.maximum.reduceat(self.weights, self.lists[:-1])
        self.times = np.zeros(len(self.terms))
        self.common = df * COMMON > self.n
        # of the commonest words, a bit for each that a row holds
        self.bit = {i: 1 << b for b, i in enumerate([i for i in np.argsort(-df, kind="stable")[:BITS].tolist() if self.common[i]])}
        self.held = np.zeros(self.n, np.uint16)
        for i, bit in self.bit.items():
            self.held[self.rows[self.lists[i] : self.lists[i + 1]]] |= np.uint16(bit)
        # the rows of every two of the other words
        at = np.flatnonzero(~self.common[self.term])
        own, size = self.term[at].astype(np.int64), np.bincount(row[at], minlength=self.n)
        self.wide = np.flatnonzero(size > WIDE)
        own_row, keys, rows = row[at], [], []
        few = size[own_row] <= WIDE
        for d in range(1, WIDE):
            i = np.flatnonzero((own_row[d:] == own_row[:-d]) & few[d:]) if d < len(own) else np.empty(0, np.int64)
            if not len(i):
                break
            keys.append(own[i] * len(self.terms) + own[i + d])
            rows.append(own_row[i].astype(np.int32))
        keys, rows = np.concatenate(keys or [np.empty(0, np.int64)]), np.concatenate(rows or [np.empty(0, np.int32)])
        order = np.argsort(keys)
        self.pairs, first = np.unique(keys[order], return_index=True)
        self.met, self.ends = rows[order], np.append(first, len(keys))

    def _all(self, at: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The scores of all records."""
        cut = [slice(self.lists[i], self.lists[i + 1]) for i in at]
        return np.bincount(np.concatenate([self.rows[c] for c in cut]), np.concatenate([self.weights[c] * q for c, q in zip(cut, times)]), self.n)

    def _sums(self, rows: np.ndarray) -> np.ndarray:
        """The scores of some records, by their own words."""
        first = self.begin[rows]
        size = self.begin[rows + 1] - first
        ends = np.cumsum(size)
        own = np.repeat(first - (ends - size), size) + np.arange(ends[-1])
        return np.add.reduceat(self.weight[own] * self.times[self.term[own]], ends - size)

    def _likely(self, at: np.ndarray, most: np.ndarray, k: int) -> np.ndarray | None:
        """Rows among which are the best ``k`` and all that equal them; none given if all have to be looked at.

        Rows that share two of the words that are not common are met by these
        two, and what they may score at most is summed; others share one such
        word or none, and are looked at if that and the common words suffice.
        """
        rest = ~self.common[at]
        words, weigh = at[rest], most[rest]
        if not 2 <= len(words) <= WIDE:
            return None
        loose, ranges = most[~rest].sum(), []
        for i, m in zip(at[~rest].tolist(), most[~rest].tolist()):
            if i in self.bit:
                ranges.append((self.bit[i], m))
        table, always = np.zeros(1), loose - sum(m for _, m in ranges)
        steps = dict(ranges)
        for b in range(len(self.bit)):
            table = np.concatenate([table, table + steps.get(1 << b, 0.0)])
        table += always
        x, y = np.triu_indices(len(words), 1)
        low, high = np.minimum(words[x], words[y]), np.maximum(words[x], words[y])
        keys, two = low * len(self.terms) + high, np.ceil((weigh[x] + weigh[y]) * UNIT).astype(np.int64)
        place = np.minimum(np.searchsorted(self.pairs, keys), max(0, len(self.pairs) - 1))
        found = np.flatnonzero(self.pairs[place] == keys) if len(self.pairs) else []
        if not len(found) or two.max() >= 1 << 24:
            return None
        met = np.sort(np.concatenate([self.met[self.ends[p] : self.ends[p + 1]].astype(np.int64) << 24 | w for p, w in zip(place[found].tolist(), two[found].tolist())]))
        row = met >> 24
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        row, times = row[first], np.diff(np.append(first, len(met)))
        # a row that shares c words is met c (c - 1) / 2 times, by each of them c - 1 times
        bound = np.add.reduceat(met & ((1 << 24) - 1), first) / UNIT / ((np.sqrt(8.0 * times + 1) - 1) / 2) + table[self.held[row]] + 1e-9
        if len(row) < k:
            return None
        some = max(0, len(row) - 4 * k)
        ahead = row[bound >= np.partition(bound, some)[some]]
        score = self._sums(ahead)
        least = np.partition(score, len(score) - k)[len(score) - k] - 1e-5
        if loose + 1e-9 >= least:
            return None
        rows = [row[bound >= least], self.wide]
        for i, m in zip(words.tolist(), weigh.tolist()):
            if m + loose + 1e-9 >= least:
                own = self.rows[self.lists[i] : self.lists[i + 1]]
                rows.append(own[table[self.held[own]] + (m + 1e-9) >= least])
        return rows[0] if len(rows) == 2 and not len(self.wide) else np.unique(np.concatenate(rows))

    def best(self, terms: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the best ``k`` and of all that come as near as 1e-5 to the last of them."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        at, times = at[known], times[known]
        if not len(at):
            return np.empty(0, np.int64), np.empty(0)
        self.times[at] = times
        rows = self._likely(at, self.top[at] * times, k)
        if rows is None:
            score = self._all(at, times)
            rows = np.arange(self.n)
        else:
            score = self._sums(rows)
        self.times[at] = 0.0
        reached = np.partition(score, len(score) - k)[len(score) - k] - 1e-5 if len(score) > k else 0.0
        near = np.flatnonzero((score >= reached) & (score > 0))
        return rows[near], score[near]


def _in_part(rows: DataFrame, part: DataFrame, k: int) -> DataFrame:
    """The top k of every left record among the right records of one part, which every worker holds."""
    # as Arrow: rows of Python objects would fill the driver
    keys, terms, weights = part.select("key", "t", "w").toArrow().columns
    keys, row = np.unique(keys.to_numpy(), return_inverse=True)
    row, terms = row.astype(np.int32), terms.to_numpy()
    by = np.lexsort((terms, row))
    own = {"keys": keys, "postings": (terms[by], row[by], weights.to_numpy()[by])}
    held = rows.sparkSession.sparkContext.broadcast(own)
    del keys, row, terms, weights, by, own

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = held.value
        keys = own["keys"]
        if "part" not in own:  # a worker keeps it for its next task
            own["part"] = Part(*own.pop("postings")) if len(keys) else None
        for b in batches:
            lefts, rights, scores, ranks = [], [], [], []
            for left, terms, times in zip(b["left_id"], b["terms"], b["times"]):
                near, score = own["part"].best(terms, times, k)
                best = np.lexsort((keys[near], -np.round(score, 6)))[:k]
                lefts.append(np.full(len(best), left))
                rights.append(keys[near[best]])
                scores.append(score[best])
                ranks.append(np.arange(1, len(best) + 1, dtype=np.int32))
            if lefts:
                yield pd.DataFrame({n: np.concatenate(x) for n, x in (("left_id", lefts), ("right_id", rights), ("score", scores), ("rank", ranks))})

    kinds = dict(rows.dtypes)["left_id"], dict(part.dtypes)["key"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.repartition(parts, "left_id").mapInPandas(run, f"left_id {kinds[0]}, right_id {kinds[1]}, score double, rank int")
    return found.withColumn("score", F.round("score", 6))


def weighed_index(right: DataFrame, rk: str = "id", rt: str = "title") -> DataFrame:
    """The postings of the right side with their BM25 weights (``key``, ``term``, ``w``), written once."""
    postings = staged(index(right, rk, rt), "postings")
    size = postings.select("key", "dl").distinct().agg(F.count("*").alias("n"), F.avg("dl").alias("a")).first()
    n, average = F.lit(float(size["n"] or 0)), F.lit(float(size["a"] or 1.0))
    df = postings.groupBy("term").agg(F.count("*").alias("df"))
    return staged(postings.join(df, "term").select("key", "term", _weight(n, average).alias("w")), "weighed")


def candidates(left: DataFrame, right: DataFrame, k: int = 10, held: int = 2_000_000, lk: str = "id", lt: str = "title", rk: str = "id", rt: str = "title", weighed: DataFrame | None = None) -> DataFrame:
    """``left_id``, ``right_id``, ``score`` (6 decimals), ``rank`` (1 to ``k``).

    A word counts as often as the left text repeats it. Ties go to the smaller
    right id. Records without words have no candidates; empty sides give none.
    About ``held`` postings of the right side are sent to all workers at once.
    ``weighed``: the index of the right side, if there is one already.
    """
    weighed = weighed_index(right, rk, rt) if weighed is None else weighed
    terms = staged(weighed.select("term").distinct().withColumn("t", F.monotonically_increasing_id()), "terms")
    words = left.select(F.col(lk).alias("left_id"), F.explode(search_terms(F.col(lt))).alias("term")).groupBy("left_id", "term").agg(F.count("*").alias("qf"))
    rows = words.join(terms, "term").groupBy("left_id").agg(F.collect_list(F.struct("t", "qf")).alias("x")).select("left_id", F.col("x.t").alias("terms"), F.col("x.qf").alias("times"))
    postings = weighed.join(terms, "term").select("key", "t", "w")
    parts = -(-weighed.count() // max(1, held)) if held else 3
    if parts <= 1:
        return _in_part(rows, postings, k)
    rows = staged(rows, "words")
    postings = staged(postings.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")), "parts")
    best = [staged(_in_part(rows, postings.where(F.col("part") == p).drop("part"), k).drop("rank"), "best") for p in range(parts)]
    rank = F.row_number().over(Window.partitionBy("left_id").orderBy(F.desc("score"), "right_id"))
    return reduce(DataFrame.unionByName, best).withColumn("rank", rank).where(F.col("rank") <= k)
