"""Similarities of strings: native where a built-in exists, else kernels over Arrow batches.

The functions below hand a whole batch to ``kernels``; words are paired for all
rows at once, and every different pair of words is looked at once. Null on
either side gives the worst score, equal strings the best, and an empty
denominator 0.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from catalink.functions.kernels import Ragged, common_by, common_lengths, common_places, edit_distances, nearest_places, numbered_words
from catalink.functions.text import STOP_WORDS, ascii_fold, clean, word_tokens


def _both(a: pd.Series, b: pd.Series) -> np.ndarray:
    """Rows in which neither is null."""
    return np.flatnonzero((a.notna() & b.notna()).to_numpy())


def _texts(x: pd.Series, rows: np.ndarray) -> list[str]:
    return x.iloc[rows].tolist()


# characters ----------------------------------------------------------------------


@pandas_udf(LongType())
def lcs_len(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of characters; null if either is."""
    rows = _both(a, b)
    out = pd.Series(pd.NA, index=range(len(a)), dtype="Int64")
    out.iloc[rows] = common_lengths(Ragged.of_texts(_texts(a, rows)), Ragged.of_texts(_texts(b, rows)))
    return out


@pandas_udf(StringType())
def lcs_text(a: pd.Series, b: pd.Series) -> pd.Series:
    """One longest common subsequence of characters; null if either is null."""
    return pd.Series([None if x is None or y is None else "".join([y[j] for j in common_places(x, y)]) for x, y in zip(a, b)])


def lcs_sim(a: Column, b: Column) -> Column:
    """Common subsequence of characters by the longer string."""
    n = F.greatest(F.length(a), F.length(b))
    score = F.when(n > 0, lcs_len(a, b) / n).otherwise(0.0)
    return F.when(a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).otherwise(score)


def title_sim(a: Column, b: Column) -> Column:
    """``lcs_sim`` of the texts folded to ASCII and lower case."""
    fold = lambda x: F.lower(ascii_fold(x))
    return F.when(a == b, 1.0).otherwise(lcs_sim(fold(a), fold(b)))


@pandas_udf(StructType([StructField("place", IntegerType()), StructField("similarity", DoubleType())]))
def _find(text: pd.Series, pattern: pd.Series, error: pd.Series) -> pd.DataFrame:
    rows = _both(text, pattern)
    t, p = _texts(text, rows), _texts(pattern, rows)
    exact = np.fromiter((x.find(y) for x, y in zip(t, p)), np.int64, len(t))
    size = np.fromiter(map(len, p), np.int64, len(p))
    most = np.where(exact < 0, (error.to_numpy()[rows] * size).astype(np.int64), 0)
    place, edits = nearest_places(t, p, most)
    out = pd.DataFrame({"place": np.full(len(text), -1, np.int32), "similarity": np.zeros(len(text))})
    score = np.where(exact >= 0, 1.0, np.where(place >= 0, 1 - edits / np.maximum(size, 1), 0.0))
    out.iloc[rows, 0], out.iloc[rows, 1] = np.where(exact >= 0, exact, place).astype(np.int32), score
    return out


def find_approx(text: Column, pattern: Column, error: float) -> Column:
    """struct(place, similarity): the leftmost place where ``pattern`` stands in
    ``text`` with the fewest errors.

    An exact occurrence gives (place, 1); else the fewest edits d up to
    ``error`` times the pattern's length, the leftmost begin with that many, and
    1 - d / length; (-1, 0) if there is none. Patterns of any length.
    """
    return _find(text, pattern, F.lit(float(error)))


# words ---------------------------------------------------------------------------


def _paired_score(a: list, b: list, measure: Callable[[Ragged, Ragged], np.ndarray]) -> np.ndarray:
    """``measure`` of the numbered words of every pair; equal lists 1, an empty one 0."""
    x, y = numbered_words(a, b)
    out = np.fromiter((len(p) == len(q) and list(p) == list(q) for p, q in zip(a, b)), np.float64, len(a))
    rows = np.flatnonzero((out == 0) & (x.size > 0) & (y.size > 0))
    out[(x.size == 0) | (y.size == 0)] = 0.0
    out[rows] = measure(x.take(rows), y.take(rows))
    return out


def _by_longer(x: Ragged, y: Ragged) -> np.ndarray:
    return common_lengths(x, y) / np.maximum(x.size, y.size)


def _by_shorter(x: Ragged, y: Ragged) -> np.ndarray:
    return common_lengths(x, y) / np.minimum(x.size, y.size)


def _by_edits(x: Ragged, y: Ragged) -> np.ndarray:
    return 1 - edit_distances(x, y) / np.maximum(x.size, y.size)


def _by_threes(x: Ragged, y: Ragged) -> np.ndarray:
    """Shared runs of three words by all such runs; 0 if there are none."""

    def runs(r: Ragged) -> np.ndarray:
        row = np.repeat(np.arange(len(r.size)), r.size)
        at = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.empty(0, np.int64)
        return np.stack([row[at], r.flat[at], r.flat[at + 1], r.flat[at + 2]], axis=1)

    p, q = np.unique(runs(x), axis=0), np.unique(runs(y), axis=0)
    every, n = np.unique(np.concatenate([p, q]), axis=0, return_counts=True)
    count = lambda r: np.bincount(r[:, 0].astype(np.int64), minlength=len(x.size))
    return count(every[n > 1]) / np.maximum(count(every), 1)


def _word_udf(measure: Callable[[Ragged, Ragged], np.ndarray]):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        rows = _both(a, b)
        out = np.zeros(len(a))
        out[rows] = _paired_score(_texts(a, rows), _texts(b, rows), measure)
        return pd.Series(out)

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return pandas_udf(run, DoubleType())


_token_lcs, _token_lcs_relaxed, _token_lev, _token_jaccard = (_word_udf(m) for m in (_by_longer, _by_shorter, _by_edits, _by_threes))


def _guarded(score: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    def run(a: Column, b: Column) -> Column:
        found = score(word_tokens(a), word_tokens(b))
        return F.when(a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).otherwise(found)

    return run


#: Similarities of word tokens, where a prefix counts as the word.
token_lcs_sim = _guarded(_token_lcs)
token_lcs_sim_relaxed = _guarded(_token_lcs_relaxed)
token_lev_sim = _guarded(_token_lev)
token_jaccard = _guarded(_token_jaccard)

PREFIX_WORD_SPLIT = "[ \\t\\n\\r\\f\\-&.,:()=\\[\\]'/]+"


def _matching(words: list[str], pairs: np.ndarray) -> np.ndarray:
    """Which pairs of words match: one begins with the other; where either holds
    more than word characters, four fifths of the shorter stand in the other."""
    plain = np.fromiter((w.isascii() and w.replace("_", "a").isalnum() for w in words), bool, len(words))
    x, y = pairs[:, 0], pairs[:, 1]
    out = np.fromiter((words[p].startswith(words[q]) or words[q].startswith(words[p]) for p, q in zip(x, y)), bool, len(x))
    rest = np.flatnonzero(~(plain[x] & plain[y]))
    p, q = Ragged.of_texts([words[k] for k in x[rest]]), Ragged.of_texts([words[k] for k in y[rest]])
    out[rest] = common_lengths(p, q) > 0.8 * np.minimum(p.size, q.size)
    return out


@pandas_udf(DoubleType())
def _prefix_words(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.zeros(len(a))
    rows = _both(a, b)
    rows = rows[np.fromiter((len(x) > 0 and len(y) > 0 for x, y in zip(_texts(a, rows), _texts(b, rows))), bool, len(rows))]
    codes, words = pd.factorize(np.array([w for c in (a, b) for x in _texts(c, rows) for w in x], object))
    n = np.fromiter(map(len, _texts(a, rows)), np.int64, len(rows))
    m = np.fromiter(map(len, _texts(b, rows)), np.int64, len(rows))
    x, y = Ragged(codes[: n.sum()], n), Ragged(codes[n.sum() :], m)
    order = np.lexsort((n, m))
    at = 0
    while at < len(order):
        part = order[at : at + max(1, 200_000 // max(1, int(n[order[at]] * m[order[at]])))]
        at += len(part)
        steps, width = int(n[part].max()), -(-int(m[part].max()) // 64) * 64
        p, q = x.padded(part, steps, -1), y.padded(part, width, -1)
        # every different pair of words of the part is compared once
        inside = (p[:, :, None] >= 0) & (q[:, None, :] >= 0)
        key = (p[:, :, None].astype(np.int64) * len(words) + q[:, None, :])[inside]
        distinct, which = np.unique(key, return_inverse=True)
        equal = np.zeros(inside.shape, bool)
        equal[inside] = _matching(words, np.stack([distinct // len(words), distinct % len(words)], axis=1))[which]
        out[rows[part]] = common_by(lambda k, e=equal: e[:, k], steps, len(part), width) / np.minimum(n[part], m[part])
    return pd.Series(out)


def prefix_word_sim(a: Column, b: Column) -> Column:
    """Common subsequence of the words that are no stop word and no number, by
    the fewer words; words match by prefix, or by their characters."""
    cut = lambda x: F.filter(F.split(F.lower(x), PREFIX_WORD_SPLIT), lambda w: (w != "") & ~w.isin(*STOP_WORDS) & ~w.rlike("^\\p{Nd}+$"))
    return _prefix_words(cut(a), cut(b))


# names ---------------------------------------------------------------------------


def _comparable(a: list, b: list) -> tuple[Ragged, Ragged, np.ndarray]:
    """Numbered words of organisation names, and the rows that may be compared:
    more than two words on either side, neither half as long (whole division) as
    the other or less, and the last words the same."""
    x, y = numbered_words(a, b)
    sizes = (x.size > 2) & (y.size > 2) & (x.size > y.size // 2) & (y.size > x.size // 2)
    rows = np.flatnonzero(sizes)
    last = lambda r: r.flat[r.begin[rows] + r.size[rows] - 1]
    return x, y, rows[last(x) == last(y)]


def _spread(x: np.ndarray, y: np.ndarray) -> float:
    """Standard deviation of where the common words stand in the longer name."""
    short, long = (x.tolist(), y.tolist()) if len(x) < len(y) else (y.tolist(), x.tolist())
    return float(np.std([long.index(long[j]) for j in common_places(short, long)]))


def _names_udf(score: Callable[[Ragged, Ragged], np.ndarray]):
    def run(a: pd.Series, b: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        both = _both(a, b)
        p, q, rows = _comparable(_texts(x, both), _texts(y, both))
        out = np.zeros(len(a))
        out[both[rows]] = score(p.take(rows), q.take(rows))
        out[(a == b).fillna(False).to_numpy(bool)] = 1.0
        return pd.Series(out)

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "x": pd.Series, "y": pd.Series, "return": pd.Series}
    return pandas_udf(run, DoubleType())


_org = _names_udf(_by_shorter)
_org_spread = _names_udf(lambda x, y: np.array([_spread(x[k], y[k]) for k in range(len(x.size))]))


def org_name_sim(a: Column, b: Column, option: str = "subsequence") -> Column:
    """Similarity of organisation names: common words by the shorter name, or
    (``std``) the spread of their places in the longer. The sizes are compared
    before Python runs."""
    x, y = word_tokens(a), word_tokens(b)
    n, m = F.size(x), F.size(y)
    hopeless = (n <= 2) | (m <= 2) | (n <= F.floor(m / 2)) | (m <= F.floor(n / 2))
    score = (_org if option == "subsequence" else _org_spread)(a, b, x, y)
    return F.when(a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).when(hopeless, 0.0).otherwise(score)


def lev_sim(a: Column, b: Column) -> Column:
    """1 - edit distance by the longer string; both empty give 0."""
    n = F.greatest(F.length(a), F.length(b))
    return F.when(a.isNull() | b.isNull(), 0.0).when(n == 0, 0.0).otherwise(1.0 - F.levenshtein(a, b) / n)


def lev_sim_clean(a: Column, b: Column) -> Column:
    """``lev_sim`` of the cleaned texts."""
    return lev_sim(clean(a), clean(b))


def char_shingle_jaccard(a: Column, b: Column, k: int = 3) -> Column:
    """Shared character shingles by all; texts shorter than ``k`` have none."""
    cut = lambda x: F.when(F.length(x) >= k, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(x) - (k - 1)), lambda i: F.substring(x, i, F.lit(k))))).otherwise(F.array().cast("array<string>"))
    p, q = cut(a), cut(b)
    n = F.size(F.array_union(p, q))
    return F.when(a.isNull() | b.isNull(), 0.0).when(n > 0, F.size(F.array_intersect(p, q)) / n).otherwise(0.0)


def same_person_name(a: Column, b: Column, distance: float = 0.4) -> Column:
    """Whether two full names are at most ``distance`` apart by their words."""
    return token_lcs_sim(a, b) >= 1 - distance


@pandas_udf(LongType())
def _people_met(a: pd.Series, b: pd.Series, x: pd.Series, y: pd.Series, least: pd.Series) -> pd.Series:
    rows = _both(a, b)
    out = pd.Series(pd.NA, index=range(len(a)), dtype="Int64")
    at_least = float(least.iloc[0]) if len(least) else 1.0
    words = {n: w for names, lists in ((a, x), (b, y)) for row in rows for n, w in zip(names.iloc[row], lists.iloc[row]) if n is not None}
    # every different pair of names is scored once
    pairs = {(p, q): p == q for row in rows for p in a.iloc[row] for q in b.iloc[row] if p is not None and q is not None}
    open_ = [pq for pq, same in pairs.items() if not same]
    scores = _paired_score([words[p] for p, _ in open_], [words[q] for _, q in open_], _by_longer)
    pairs.update(zip(open_, scores >= at_least))
    out.iloc[rows] = [sum(any(pairs.get((p, q), False) for p in a.iloc[row]) for q in b.iloc[row]) for row in rows]
    return out


def people_met(a: Column, b: Column, distance: float = 0.4) -> Column:
    """How many names of ``b`` are the same person's as one of ``a``, by
    ``same_person_name``; each counts once, and one of ``a`` may meet several."""
    words = lambda x: F.transform(x, word_tokens)
    return _people_met(a, b, words(a), words(b), F.lit(1 - distance))


def register(spark: SparkSession) -> list[str]:
    """Makes the similarities callable from SQL; returns their names.

    Token functions take arrays of words, as ``word_tokens`` gives them.
    """
    functions = {"lcs_len": lcs_len, "lcs_text": lcs_text, "prefix_words": _prefix_words, "approx_find": _find, "token_lcs": _token_lcs, "token_lev": _token_lev, "token_jaccard": _token_jaccard, "org_sim": _org}
    for name, function in functions.items():
        spark.udf.register(name, function)
    return list(functions)
