"""Mixing sources to target weights: subset-sum budget fitting.

Documents are counted by source and exact token length. From the target shares
and what each source can give at most follows one budget in tokens per source.
Whole passes over a source take all its documents; what remains of its budget
is fitted by a bounded knapsack over the counts by length, source by source on
the executors, and the chosen number of documents of each length is drawn by a
seeded order. Only one total per source reaches the driver.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalink.sources.tables import broadcast_if_small, staged

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the splitting pattern published with the default vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Tokens that the knapsack fits first; and up to how many if they do not suffice.
WINDOW, MOST = 1 << 16, 1 << 28
#: Bits that the fast knapsack may hold for going back.
HELD = 1 << 30


def counter(name: str, data: bytes):
    """A function that counts the tokens of a text by a vocabulary file's bytes."""
    if name.endswith(".json"):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(data.decode())
        whole.encode_special_tokens = True
        return lambda text: len(whole.encode(text, add_special_tokens=False).ids)
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda text: len(pieces.encode(text))
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}
    ordinary = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(ordinary.encode_ordinary(text))


def token_lengths(documents: DataFrame, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens`` by the vocabulary file ``tokenizer``.

    The driver reads the file and sends it to the executors; null texts have 0
    tokens.
    """
    data = documents.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(tokenizer, data.value)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "n_tokens": [count(t) if t else 0 for t in b["text"]]})

    return documents.select("doc_id", "source", "text").mapInPandas(run, "doc_id long, source string, n_tokens int")


def _bundles(lengths: list[int], counts: list[int], top: int) -> list[tuple[int, int, int]]:
    """(which length, how many, tokens): any number up to the count is a sum of some."""
    out = []
    for k, (n, c) in enumerate(zip(lengths, counts)):
        c, size = min(c, top // n if n else 0), 1
        while c > 0:
            use = min(size, c)
            out.append((k, use, n * use))
            c, size = c - use, size * 2
    return out


def _reach(bundles: list[tuple[int, int, int]], mask: int) -> int:
    """Bit s is set if some of the bundles sum up to s."""
    found = 1
    for _, _, weight in bundles:
        found |= found << weight & mask
    return found


def _some(bundles: list[tuple[int, int, int]], goal: int) -> list[tuple[int, int, int]]:
    """Bundles that sum up to ``goal``, which can be reached; in little memory:
    the bundles are halved and a sum of either half that completes the other found."""
    if not goal:
        return []
    if len(bundles) == 1:
        return bundles
    mask = (1 << (goal + 1)) - 1
    half = len(bundles) // 2
    a, b = _reach(bundles[:half], mask), _reach(bundles[half:], mask)
    mirrored = int(format(b, f"0{goal + 1}b")[::-1], 2)
    both = a & mirrored
    part = (both & -both).bit_length() - 1
    return _some(bundles[:half], part) + _some(bundles[half:], goal - part)


def nearest(lengths: list[int], counts: list[int], budget: int) -> tuple[list[int], int]:
    """How many of each length so that the sum is nearest to ``budget``, and the sum.

    Bounded knapsack by binary splitting over a bit set of reachable sums, which
    are known up to the longest length above the budget; of two equally near
    ones the smaller wins.
    """
    top = budget + max(lengths)
    mask = (1 << (top + 1)) - 1
    bundles, steps, reach = _bundles(lengths, counts, top), [], 1
    keep = len(bundles) * top <= HELD
    for n, (_, _, weight) in enumerate(bundles, 1):
        if keep:
            steps.append(reach)
        reach |= reach << weight & mask
        if reach >> budget & 1:
            bundles = bundles[:n]
            break
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    above = budget + 1 + (above & -above).bit_length() - 1 if above else None
    goal = below if above is None or budget - below <= above - budget else above
    out, rest = [0] * len(lengths), goal
    if keep:
        for (k, use, weight), before in zip(reversed(bundles[: len(steps)]), reversed(steps)):
            if not before >> rest & 1:
                out[k] += use
                rest -= weight
    else:
        for k, use, _ in _some(bundles, goal):
            out[k] += use
    return out, goal


def _in_proportion(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """Counts whose sum is at most ``budget`` and near it: the same part of all
    lengths, what is rounded off given back to the largest remainders."""
    part = budget / sum(n * c for n, c in zip(lengths, counts))
    taken = [min(c, int(c * part)) for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, taken))
    for k in sorted(range(len(lengths)), key=lambda k: (taken[k] - counts[k] * part, k * 7919 % len(lengths))):
        if taken[k] < counts[k] and lengths[k] <= left:
            taken[k] += 1
            left -= lengths[k]
    return taken


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take so that the sum is nearest to ``budget``.

    A small knapsack over what an equal part of all lengths leaves open nearly
    always meets the budget to the token, and then nothing is nearer. Else the
    window grows up to the whole budget (or to 2**28 tokens, if that is less),
    so for budgets up to there the sum is the nearest of all.
    """
    if budget >= sum(n * c for n, c in zip(lengths, counts)):
        return list(counts)
    if budget <= 0:
        return [0] * len(lengths)
    # all sums are multiples of the lengths' common divisor
    step = math.gcd(*(n for n, c in zip(lengths, counts) if c))
    least = min(budget % step, -budget % step)
    best, window = None, WINDOW
    while True:
        base = _in_proportion(lengths, counts, budget - window // 2) if budget > window else [0] * len(lengths)
        done = sum(n * t for n, t in zip(lengths, base))
        more, got = nearest(lengths, [c - t for c, t in zip(counts, base)], budget - done)
        miss = abs(done + got - budget)
        if best is None or miss < best[0]:
            best = (miss, [t + m for t, m in zip(base, more)])
        if best[0] == least or budget <= window or window >= MOST:
            return best[1]
        window *= 16


def budgets(targets: dict[str, tuple[float, int]], available: dict[str, int], total: int | None) -> dict[str, int]:
    """Tokens for each source: its share of ``total``, at most what it can give.

    Without a ``total``, the largest at which the mix has all its shares; if a
    source of the mix can give nothing, the rest share as they do to each
    other. With one, sources that fall short leave their part open.
    """
    most = {s: available.get(s, 0) * repeats for s, (_, repeats) in targets.items()}
    live = {s: share for s, (share, _) in targets.items() if share > 0 and most[s] > 0}
    if not live:
        return dict.fromkeys(targets, 0)
    if total is None:
        whole = sum(live.values())
        total = int(min(most[s] / (share / whole) for s, share in live.items()))
        live = {s: share / whole for s, share in live.items()}
    return {s: min(most[s], round(live.get(s, 0.0) * total)) for s in targets}


def plan(source: str, lengths: list[int], counts: list[int], wanted: int, repeats: int) -> pd.DataFrame:
    """Rows (``source``, ``n_tokens``, ``passes``, ``extra``): every document of
    that length is used ``passes`` times and ``extra`` of them once more."""
    passes, rest = divmod(wanted, sum(n * c for n, c in zip(lengths, counts)))
    passes, rest = (repeats, 0) if passes >= repeats else (passes, rest)
    extra = fit(lengths, counts, rest)
    rows = [(source, n, passes, e) for n, e in zip(lengths, extra) if passes or e]
    return pd.DataFrame(rows, columns=["source", "n_tokens", "passes", "extra"])


def mixed(lengths: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 7) -> DataFrame:
    """The mix: ``doc_id``, ``source``, ``n_tokens``, ``uses`` (1 or more).

    ``lengths`` comes from ``token_lengths``; ``targets`` has ``source``,
    ``target_share``, ``max_repeats`` and is small by nature (one row per
    source). Sources without a target, null sources and documents without
    tokens are not used. Among documents of one length the seeded order of
    their ids decides; of rows with one id the longest counts. Empty tables give
    an empty mix.
    """
    spark = lengths.sparkSession
    rows = staged(lengths.where("source is not null and doc_id is not null and n_tokens > 0").groupBy("doc_id").agg(F.max(F.struct("n_tokens", "source")).alias("x")).select("doc_id", "x.source", "x.n_tokens"), "lengths")
    wanted = {r["source"]: (r["target_share"] or 0.0, r["max_repeats"] or 0) for r in targets.where("source is not null").toLocalIterator()}
    counts = staged(rows.groupBy("source", "n_tokens").agg(F.count("*").alias("n")), "counts")
    named = spark.createDataFrame([(s,) for s in wanted], "source string")
    available = {r["source"]: r["tokens"] for r in counts.join(F.broadcast(named), "source", "left_semi").groupBy("source").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("tokens")).toLocalIterator()}
    goal = budgets(wanted, available, total)

    def planned(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n_tokens", ascending=False)
        source = rows["source"].iloc[0]
        return plan(source, rows["n_tokens"].tolist(), rows["n"].tolist(), goal[source], wanted[source][1])

    # a source has one row per different length, not per document
    chosen = counts.join(F.broadcast(named), "source", "left_semi").groupBy("source").applyInPandas(planned, "source string, n_tokens int, passes long, extra long")
    # the seeded order splits every length into slices first, so no task ranks a hot length alone
    slice_ = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(64))
    sized = rows.join(broadcast_if_small(chosen), ["source", "n_tokens"]).withColumn("slice", slice_).withColumn("order", F.xxhash64(F.lit(seed), "doc_id"))
    held = sized.groupBy("source", "n_tokens", "slice").agg(F.count("*").alias("n"))
    before = held.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("source", "n_tokens").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("source", "n_tokens", "slice").orderBy("order", "doc_id"))
    placed = sized.withColumn("rank", rank).join(before, ["source", "n_tokens", "slice"])
    uses = F.col("passes") + F.when(F.col("before") + F.col("rank") <= F.col("extra"), 1).otherwise(0)
    return placed.withColumn("uses", uses.cast("int")).where("uses > 0").select("doc_id", "source", "n_tokens", "uses")


def shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """What each source of the targets reached: ``source``, ``target_share``,
    ``max_repeats``, ``documents``, ``uses``, ``most_uses``, ``tokens``, ``actual_share``."""
    by = mix.groupBy("source").agg(F.count("*").alias("documents"), F.sum("uses").alias("uses"), F.max("uses").alias("most_uses"), F.sum(F.col("uses") * F.col("n_tokens")).alias("tokens"))
    all_ = targets.join(by, "source", "left").fillna(0, ["documents", "uses", "most_uses", "tokens"])
    total = F.sum("tokens").over(Window.partitionBy())
    share = F.when(total > 0, F.round(F.col("tokens") / total, 6)).otherwise(0.0)
    return all_.select("source", "target_share", "max_repeats", "documents", "uses", "most_uses", "tokens", share.alias("actual_share"))
