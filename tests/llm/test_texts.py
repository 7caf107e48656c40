import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from catalink.llm.leakage import Leak, leaks, matches, words
from catalink.llm.spans import COVER_133, Cover, Hasher, coverage, links, members, shared_pairs

VOCABULARY = [f"w{i}" for i in range(60)] + ["the", "of", "and"] * 4


def leaked(frame, docs, items, leak=Leak()):
    got = leaks(frame(docs, "doc_id long, text string"), frame(items, "item_id long, item_text string"), leak)
    return sorted(tuple(r) for r in got.collect())


ITEM = " ".join(f"word{i}" for i in range(20))


def test_leaks(frame):
    w = ITEM.split()
    docs = [
        (1, "before " + ITEM.upper() + " after"),
        (2, " ".join(w[:14])),
        (3, " ".join(w[:15])),
        (4, ",\n ".join(w[2:18])),
        (5, " ".join(x if i not in (4, 11) else "other" for i, x in enumerate(w))),
        (6, " ".join(w[:7] + ["in", "addition"] + w[7:12] + w[13:])),
        (7, " ".join(w[::-1])),
        (8, " ".join(f"{x} odd" for x in w)),
        (9, None),
        (10, ""),
        (11, " ".join(w[:8]) + " x " * 30 + " ".join(w[8:])),
        (1, "before " + ITEM + " after"),
        (12, "filler " * 100_000 + ITEM),
        (None, ITEM),
    ]
    items = [(1, ITEM), (2, "too short to leak"), (3, None), (4, ITEM + " and more of it"), (1, ITEM)]
    expected = [(d, i) for d in (1, 3, 4, 5, 6, 12) for i in (1, 4)]
    # every second word another one: in order, but not nearly so
    assert leaked(frame, docs, items) == sorted(expected)
    assert leaked(frame, docs, items, Leak(block_items=1, block_words=40)) == sorted(expected)
    assert leaked(frame, [], items) == [] and leaked(frame, docs, []) == []


def brute(item, doc, leak):
    """Whether a chain of equal words keeps to the limits: for every end, the
    fewest skipped words of a chain of k words."""
    best = {}
    for i, a in enumerate(item):
        for j, b in enumerate(doc):
            if a == b:
                c = {1: 0}
                for di in range(1, leak.gap + 2):
                    for dj in range(1, leak.gap + 2):
                        for k, s in best.get((i - di, j - dj), {}).items():
                            c[k + 1] = min(c.get(k + 1, 9999), s + max(di, dj) - 1)
                best[i, j] = c
                if any(k >= leak.min_words and s <= leak.skipped * k for k, s in c.items()):
                    return True
    return False


def test_a_leak_may_go_on_badly(frame):
    w = [f"word{i}" for i in range(60)]
    doc = w[:15] + [x for k in range(17, 60, 3) for x in ("some", "other", w[k])]
    near = w[:6] + ["x"] + w[6:11] + w[12:18]
    got = matches(frame([(1, " ".join(doc)), (2, " ".join(near)), (3, " ".join(w[:14]))], "doc_id long, text string"), frame([(5, " ".join(w))], "item_id long, item_text string"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5, "phrase"), (2, 5, "near")]


def test_words_of_very_long_items_and_texts(frame):
    rng = random.Random(3)
    item = [f"v{rng.randrange(3000)}" for _ in range(70_000)]
    docs = [(1, " ".join(item[66_000:66_020])), (2, " ".join(rng.choices(["v1", "v2", "zz"], k=200_000) + item[69_980:]))]
    assert leaked(frame, docs, [(9, " ".join(item))]) == [(1, 9), (2, 9)]


def test_leaks_against_every_pair(frame):
    rng = random.Random(6)
    leak = Leak()
    items = [(i, " ".join(rng.choices(VOCABULARY, k=rng.randint(15, 30)))) for i in range(12)]
    docs = []
    for d in range(150):
        t = rng.choices(VOCABULARY, k=rng.randint(0, 50))
        if rng.random() < 0.7:
            w = items[rng.randrange(12)][1].split()
            part = w[rng.randrange(6) :][: rng.randint(10, 30)]
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(part))
                part[k : k + rng.randint(0, 1)] = rng.choices(VOCABULARY, k=rng.randint(0, 1))
                part = part or ["x"]
            at = rng.randint(0, len(t))
            t[at:at] = part
        docs.append((d, " ".join(t)))
    expected = sorted((d, i) for d, t in docs for i, x in items if brute(words(x), words(t), leak))
    assert leaked(frame, docs, items, leak) == expected and len(expected) > 20


def test_cover():
    assert len({(a - b) % 133 for a in COVER_133 for b in COVER_133}) == 133
    with pytest.raises(ValueError):
        Cover(7, (0, 1))


@given(st.binary(min_size=20, max_size=80), st.integers(1, 8))
@settings(max_examples=100, deadline=None)
def test_hashes_do_not_depend_on_the_place(data, shift):
    codes = np.frombuffer(data, np.uint8)
    moved = np.concatenate([np.full(shift, 7, np.uint8), codes])
    hashed = Hasher(100)
    a = hashed(codes, 12, np.arange(len(codes) - 11))
    b = hashed(moved, 12, np.arange(len(codes) - 11) + shift)
    assert (a == b).all()


def all_pairs(docs, n):
    sets = {d: {t[k : k + n] for k in range(len(t) - n + 1)} for d, t in docs if d is not None and t}
    return sorted((a, b) for a in sets for b in sets if a < b and sets[a] & sets[b])


@pytest.mark.parametrize("few", [0, 3, 64])
def test_shared_spans(frame, few):
    cover = Cover(few=few)
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choices("abcdef äß\n\U0001f600", k=n))
    passages = [noise(rng.randint(280, 420)) for _ in range(6)] + [noise(300), noise(299), noise(301)]
    docs = []
    for d in range(60):
        t = noise(rng.randint(0, 200))
        for p in rng.sample(passages, rng.randint(0, 2)):
            t += p + noise(rng.randint(0, 150))
        docs.append((d, t))
    docs += [(100, docs[0][1]), (101, docs[0][1]), (102, None), (103, ""), (104, "x" * 299), (105, "x" * 299), (106, "y" * 1000), (107, "y" * 300), (None, "y" * 300)]
    df = frame([(d, t, 1) for d, t in docs], "doc_id long, text string, rep int")
    got = sorted(tuple(r) for r in shared_pairs(df, 300, cover).collect())
    assert got == all_pairs(docs, 300) and len(got) > 20
    share = {r["doc_id"]: r["shared_chars"] for r in coverage(df.where("doc_id is not null"), 300, cover).collect()}
    sets = {d: {t[k : k + 300] for k in range(len(t) - 299)} for d, t in docs if d is not None and t}
    for d, t in docs:
        if d is None:
            continue
        other = set().union(*(s for x, s in sets.items() if x != d))
        inside = set()
        for k in range(len(t or "") - 299):
            if t[k : k + 300] in other:
                inside.update(range(k, k + 300))
        assert share[d] == len(inside)


def test_one_passage_in_very_many_texts(frame, spark):
    from pyspark.sql import functions as F

    n = 20_000
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefghijk lmnop", k=310))
    notice = "".join(rng.choices("abcdefghijk lmnop", k=250))
    noise = F.sha2(F.col("id").cast("string"), 256)
    held = F.when(F.col("id") % 2 == 0, F.lit(passage)).otherwise(notice)
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.substring(noise, F.lit(1), (F.col("id") % 41).cast("int")), held, noise).alias("text"))
    found = links(df)[1]
    rows = found.collect()
    # the smallest text is linked to each other one; where the noise agrees, too, there are smaller passages within
    got = {(r["rep_a"], r["rep_b"]) for r in rows}
    assert got >= {(0, k) for k in range(2, n, 2)} and all(a < b and a % 2 == b % 2 == 0 for a, b in got) and len(rows) < 10 * n
    classes = {r["doc_id"]: r["class_id"] for r in members(df).collect()}
    assert all(classes[k] == (0 if k % 2 == 0 else k) for k in range(n))
    share = coverage(df).groupBy("shared_chars").count().collect()
    assert {r[0]: r[1] for r in share}[0] == n // 2 and min(r[0] for r in share if r[0]) >= 310


def test_shared_spans_of_nothing(frame):
    empty = frame([], "doc_id long, text string")
    assert shared_pairs(empty).count() == 0 and coverage(empty).count() == 0
    assert shared_pairs(frame([(1, "short"), (2, "short")], "doc_id long, text string")).count() == 0
