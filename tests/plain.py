"""One-by-one versions of what the library computes batch by batch."""


def lcs_table(a, b):
    table = [[0] * (len(b) + 1)]
    for x in a:
        before, row = table[-1], [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
        table.append(row)
    return table


def lcs_length(a, b):
    return lcs_table(a, b)[-1][-1]


def lcs_string(a, b):
    """One longest common subsequence; going back, up only if that is longer."""
    table = lcs_table(a, b)
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            out.append(a[i - 1])
            i, j = i - 1, j - 1
        elif table[i - 1][j] > table[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        corner, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
    return row[-1]


def same_word(a, b):
    short, long = (a, b) if len(a) < len(b) else (b, a)
    return long.startswith(short) or (short[:1] == long[:1] and lcs_length(long, short) > 0.9 * len(short))


def paired_tokens(a, b):
    ids_a, ids_b = {}, {}
    for w in a:
        if w in ids_a:
            continue
        ids_a[w] = len(ids_a)
        best, found = 0.0, None
        for v in b:
            if same_word(w, v):
                ratio = min(len(w), len(v)) / max(len(w), len(v))
                if ratio > best:
                    best, found = ratio, v
        if found is not None:
            ids_b[found] = ids_a[w]
    fresh, out = len(ids_a), []
    for v in b:
        if v not in ids_b:
            ids_b[v], fresh = fresh, fresh + 1
        out.append(ids_b[v])
    return [ids_a[w] for w in a], out


def token_score(a, b, measure):
    if a is None or b is None:
        return 0.0
    if list(a) == list(b):
        return 1.0 if len(a) else 0.0
    x, y = paired_tokens(list(a), list(b))
    return measure(x, y) if x and y else 0.0


def token_lcs(a, b):
    return token_score(a, b, lambda x, y: lcs_length(x, y) / max(len(x), len(y)))


def token_lcs_relaxed(a, b):
    return token_score(a, b, lambda x, y: lcs_length(x, y) / min(len(x), len(y)))


def token_lev(a, b):
    return token_score(a, b, lambda x, y: 1 - edit_distance(x, y) / max(len(x), len(y)))


def token_jaccard(a, b):
    cut = lambda x: {tuple(x[i : i + 3]) for i in range(len(x) - 2)}
    return token_score(a, b, lambda x, y: len(cut(x) & cut(y)) / len(cut(x) | cut(y)) if cut(x) | cut(y) else 0.0)


def organisation(a, b, tokens_a, tokens_b, spread=False):
    if a is None or b is None:
        return 0.0
    if a == b:
        return 1.0
    x, y = paired_tokens(list(tokens_a), list(tokens_b))
    if len(x) <= 2 or len(y) <= 2 or len(x) <= len(y) // 2 or len(y) <= len(x) // 2 or x[-1] != y[-1]:
        return 0.0
    short, long = (x, y) if len(x) < len(y) else (y, x)
    if not spread:
        return lcs_length(short, long) / len(short)
    at = [long.index(t) for t in lcs_string(short, long)]
    mean = sum(at) / len(at)
    return (sum((i - mean) ** 2 for i in at) / len(at)) ** 0.5


def prefix_words(x, y):
    """Of two lists of words: common subsequence by the fewer words."""
    import re

    if not x or not y:
        return 0.0

    def equal(s, t):
        if re.fullmatch(r"\w+", s, re.A) and re.fullmatch(r"\w+", t, re.A):
            return s.startswith(t) or t.startswith(s)
        return lcs_length(s, t) / min(len(s), len(t)) > 0.8

    row = [0] * (len(y) + 1)
    for s in x:
        corner = 0
        for j, t in enumerate(y, 1):
            up = row[j]
            row[j] = corner + 1 if equal(s, t) else max(up, row[j - 1])
            corner = up
    return row[-1] / min(len(x), len(y))


def approx_find(text, pattern, error):
    """By every substring: fewest edits, then leftmost."""
    if text is None or pattern is None:
        return -1, 0.0
    if pattern in text:
        return text.index(pattern), 1.0
    m = len(pattern)
    most = int(error * m)
    best = (most + 1, -1)
    for i in range(len(text)):
        # edit distances of the pattern to all texts that begin here
        row = list(range(m + 1))
        for c in text[i : i + m + most + 1]:
            corner, row[0] = row[0], row[0] + 1
            for k in range(1, m + 1):
                corner, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, corner + (pattern[k - 1] != c))
            best = min(best, (row[m], i))
    return (best[1], 1 - best[0] / m) if most and best[0] <= most else (-1, 0.0)
