"""The stages of the pipeline in plain Python, written apart from the operators."""

import math
import re
from collections import Counter, defaultdict

import regex

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = regex.compile(r"""^[("'«‹‘“‚„¿¡「『(]*\p{L}[\p{L}\p{M}‌‍'’-]*[.,;:!?)"'»›’“”…;·،؛؟۔।॥։፡-፨၊။។៕、。」』!),:;?]*$""")


def words(text):
    return WORD.findall(text or "")


def rule_votes(text):
    """(bad, good) conditions of the eight rules, over the whole text."""
    text = text or ""
    w = words(text)
    n = max(len(w), 1)
    chars = max(sum(map(len, w)), 1)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    symbols = len(re.findall(r"[#*$%&|<>]", text)) / n
    upper = len(regex.findall(r"\p{Lu}", text)) / chars
    shouts = len(re.findall("[!?]", text)) / n
    repeats = len(covered) / n
    copies = len(lines) - len(set(lines))
    variety = len(set(w)) / min(n, 400)
    plain = sum(bool(PLAIN.match(x)) for x in w) / n
    length = sum(map(len, w)) / n
    pairs = {"symbols": (symbols > 0.1, symbols < 0.03), "upper": (upper > 0.4, upper < 0.2), "shouts": (shouts > 0.2, shouts < 0.05),
             "repeats": (repeats > 0.35, repeats < 0.02), "lines": (copies / max(len(lines), 1) > 0.5, copies == 0),
             "variety": (n >= 50 and variety < 0.15, n >= 50 and variety > 0.3), "plain": (plain < 0.6, plain > 0.85),
             "length": (length < 2.5 or length > 14, 3.5 <= length <= 10)}
    votes = tuple(-1 if bad else 1 if good else 0 for bad, good in pairs.values())
    return votes, len(w) < 20 or 100 * len(covered) > 30 * len(w)


def keep_good(docs, least=0.01, steps=30):
    """Document by document EM over the votes; (id, text, source) rows that stay."""
    judged = [(row, *rule_votes(row[1])) for row in docs]
    n_rules = 8
    start = {(1, 1): 0.99, (1, -1): 0.01, (0, 1): 0.7, (0, -1): 0.3}
    rate = {(i, *k): v for i in range(n_rules) for k, v in start.items()}
    prior, pseudo = 0.85, max(1.0, len(docs) / 1000)

    def good(votes):
        x = math.log(prior / (1 - prior)) + sum(math.log(rate[i, 1, v] / rate[i, 0, v]) for i, v in enumerate(votes) if v)
        return 1 / (1 + math.exp(-x))

    for _ in range(steps):
        post = [good(v) for _, v, _ in judged]
        sums = {k: pseudo * start[k[1:]] for k in rate}
        for p, (_, votes, _) in zip(post, judged, strict=True):
            for i, v in enumerate(votes):
                if v:
                    sums[i, 1, v] += p
                    sums[i, 0, v] += 1 - p
        new = {(i, y, v): min(max(sums[i, y, v] / (sums[i, y, 1] + sums[i, y, -1]), least), 1 - least) for i, y, v in rate}
        new_prior = (sum(post) + pseudo * 0.85) / (len(docs) + pseudo)
        moved = max(abs(new_prior - prior), *(abs(new[k] - rate[k]) for k in rate))
        rate, prior = new, new_prior
        if moved < 1e-4:
            break
    return [row for row, votes, failed in judged if not failed and good(votes) >= 0.5]


def drop_equal(docs):
    best = {}
    for row in docs:
        key = row[1] or ""
        if key not in best or row[0] > best[key][0]:
            best[key] = row
    return list(best.values())


def shingles(text, k=5):
    w = [bytes(x.encode()).lower() for x in words(text)]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def drop_near(docs, percent=80):
    """All pairs compared; one row of each component stays, that of the smallest id."""
    sets = [shingles(t) for _, t, _ in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, row in enumerate(docs):
        groups[root(i)].append(row)
    return [min(g, key=lambda r: r[0]) for g in groups.values()]


def targets(sizes, weights=(5, 2, 1), budget=1.5, cap=2):
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    fixed = {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = budget * sum(sizes.values()) - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > cap * sizes[s]}
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}
