"""Personal data by a skip-chain conditional random field over candidate tokens.

Base spans come from four fixed patterns. The chain's tokens are what might be personal data: runs of characters with a
digit or an at sign, cut at the edges of base spans and where a new number begins. Each has a label, one of the four kinds
or none; neighbours share a transition potential. Tokens of one document that have the same normal form (digits alone for
numbers, lower case otherwise), and forms that look alike (the same shape of digits, letters and marks), share a skip
potential however far apart they are. A group's skip links meet in one node, and loopy max-sum messages run over chain
and groups until they no longer change. Tokens of a base span are clamped to its kind, and their word counts in the group
as often as the group has other members, as if each were linked with each; other tokens labelled with a kind become added
spans. Weights are learned by perceptron updates on a bounded sample of the documents themselves: base spans as written
and with a prefix or separators dropped are the positives, other candidates the negatives.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, pick

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
#: The base patterns (fixed values). A lookbehind is not needed where a run of digits is taken whole: no later start in
#: the same run can do better, and possessive runs keep long ones linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]+")
LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
#: Candidates of the chain: white-space tokens with a digit or an at sign, joined over single blanks while digits go on.
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*(?: [(]?[0-9]\S*)*")
CANDIDATE = re.compile(r"[0-9@]")
PIECE = re.compile(r"\S+")
EDGES = ".,;:!?\"'|#*$%&<>[]{}"
STILL = 1e-6  # messages that change by less have come to rest
#: The weights are fitted on a bounded sample: so many documents that may hold a base span, and as many that hold a digit
#: or an at sign, in the order of a hash of their ids and texts, none of more than TRAIN_CHARS characters.
#: They are looked for in a share of all documents, drawn by that hash, of about POOL documents.
TRAIN_DOCS = 2000
TRAIN_CHARS = 20_000
POOL = 40_000


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of the four patterns, leftmost and without overlaps within a kind; code points, end exclusive."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    cur, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > cur and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out[0].append((start, m.end()))
            cur = m.end()
        else:
            cur = max(cur, at + 1)
        at = text.find("@", cur)
    for m in IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 8 else int(p.lstrip("0")[:4] or 0) <= 255 and len(p.lstrip("0")) < 4 for p in m[0].split(".")):
            out[1].append(m.span())
    for m in CARD.finditer(text):
        if 12 < m.end() - m.start() < 38 and 13 <= len(d := DIGITS.sub("", m[0])) <= 19 and luhn(d):
            out[2].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGITS.sub("", m[0])) <= 15:
                out[3].append(m.span())
    return out


# -- the random field --------------------------------------------------------------------------------------------------
def tokens_of(text: str, base: list[list[tuple[int, int]]] | None = None) -> list[tuple[int, int]]:
    """Candidates in order: base spans, and what is left of the runs of number words around them. In a run with one number
    after the other a new candidate begins at a plus sign or a bracket, or where both sides have digits for a number."""
    taken = joined_spans([x for own in base or [] for x in own])
    out, p = [], 0
    for m in TOKEN.finditer(text):
        a, end = m.span()
        while p < len(taken) and taken[p][1] <= a:
            p += 1
        while p < len(taken) and taken[p][0] < end:
            out += numbers_of(text, a, max(a, taken[p][0]))
            a = taken[p][1]
            p += 1
        out += numbers_of(text, a, end)
    return sorted({x for x in out if trimmed(text, *x)} | set(taken))


def trimmed(text: str, a: int, b: int) -> tuple[int, int] | None:
    while a < b and (text[a] in EDGES or text[a].isspace()):
        a += 1
    while a < b and (text[b - 1] in EDGES or text[b - 1].isspace()):
        b -= 1
    return (a, b) if b - a > 1 and CANDIDATE.search(text, a, b) else None


def numbers_of(text: str, a: int, b: int) -> list[tuple[int, int]]:
    out, digits, start = [], 0, a
    for m in PIECE.finditer(text, a, b):
        own = sum(c.isdigit() for c in m[0])
        if digits >= 7 and (m[0][0] in "+(" or own >= 7 or digits + own > 19):
            out.append((start, m.start()))
            start, digits = m.start(), 0
        digits += own
    out.append((start, b))
    return [x for x in (trimmed(text, *s) for s in out) if x]


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def normal(token: str) -> str:
    """What equal entities have in common however they are written: the last nine digits and their number without a
    country's, for numbers; lower case for others."""
    if any(c.isalpha() or c == "@" for c in token):
        return token.strip(EDGES).lower()
    digits = DIGITS.sub("", token)
    return digits[-9:] if 9 <= len(digits) <= 12 else digits


def shape(token: str) -> str:
    """Runs of digits keep their lengths, runs of letters do not; a plus sign in front does not count."""
    return re.sub(r"[0-9]+", lambda m: f"9{len(m[0])}", re.sub(r"[^\W\d_]+", "a", token.lstrip("+")))


def features(token: str) -> list[str]:
    digits = sum(c.isdigit() for c in token)
    return [
        f"digits:{min(digits, 20)}",
        f"groups:{min(len(re.findall(r'[0-9]+', token)), 6)}",
        f"at:{'@' in token}",
        f"dots:{min(token.count('.'), 4)}",
        f"plus:{token.startswith('+')}",
        f"letters:{any(c.isalpha() for c in token)}",
        f"dashes:{min(token.count('-'), 4)}",
        f"round:{'(' in token}",
        f"luhn:{12 < digits < 20 and luhn(DIGITS.sub('', token))}",
        f"long:{len(token) > 40}",
        "any",
    ]


def unary(token: str, weights: dict[tuple[str, int], float]) -> np.ndarray:
    out = np.zeros(NONE + 1)
    for f in features(token):
        for k in range(NONE + 1):
            out[k] += weights.get((f, k), 0.0)
    return out


def groups_of(tokens: list[str]) -> tuple[list[int], list[int]]:
    """For each token the number of its normal form's group, and for each such group the number of its shape's."""
    form: dict[str, int] = {}
    kind: dict[str, int] = {}
    own, above = [], []
    for t in tokens:
        n = normal(t)
        if n not in form:
            form[n] = len(form)
            above.append(kind.setdefault(shape(t), len(kind)))
        own.append(form[n])
    return own, above


def decoded(scores: np.ndarray, clamped: np.ndarray, own: list[int], above: list[int], pair: tuple[float, float, float]) -> np.ndarray:
    """Labels by loopy max-sum messages over the chain, over groups of one normal form, and over groups of one shape;
    every potential rewards equal labels. clamped: tokens whose label is certain.

    A clamped token's link weighs as much as links with each other member of its group would together. Messages are sent
    until none changes; each round is damped more than the one before, so they come to rest in loops as well.
    """
    n, forms = len(scores), len(above)
    kinds = max(above, default=-1) + 1
    alone, lone_kind = np.bincount(own, minlength=forms), np.bincount(above, minlength=kinds)
    if n == 1 or not (pair[0] or alone.max() > 1 or lone_kind.max() > 1):
        return scores.argmax(1)
    own_a, above_a = np.array(own), np.array(above)
    chain = np.arange(n - 1)
    weight = np.where(clamped, np.maximum(alone[own_a] - 1, 1), 1) * pair[1]
    sure = np.zeros(forms)
    np.add.at(sure, own_a, clamped)
    up = np.where(sure > 0, np.maximum(lone_kind[above_a] - 1, 1), 1) * pair[2]
    one = np.concatenate((chain, np.arange(n), n + np.arange(forms)))
    two = np.concatenate((chain + 1, n + own_a, n + forms + above_a))
    w = np.concatenate((np.full(n - 1, pair[0]), weight, up))
    m = len(one)
    a, b, w = np.concatenate((one, two)), np.concatenate((two, one)), np.concatenate((w, w))[:, None]
    back = np.concatenate((np.arange(m, 2 * m), np.arange(m)))
    field = np.zeros((n + forms + kinds, scores.shape[1]))
    field[:n] = scores
    said = np.zeros((2 * m, scores.shape[1]))
    for k in range(len(field) + 100):  # no path is longer than the nodes
        heard = field.copy()
        np.add.at(heard, b, said)
        told = heard[a] - said[back]
        told = np.maximum(told + w, told.max(1, keepdims=True))
        told -= told.max(1, keepdims=True)
        change = np.abs(told - said).max()
        if change < STILL:
            break
        keep = 0.0 if k < 20 else min(0.95, (k - 19) / 60)
        said = keep * said + (1 - keep) * told
    heard = field.copy()
    np.add.at(heard, b, said)
    return heard[:n].argmax(1)


#: How base spans are rewritten for training: fixed examples of what people leave out.
REWRITES = (
    lambda t: t.lstrip("+"),
    lambda t: re.sub(r"^\+[0-9]{1,2}[ .-]*", "", t),
    lambda t: re.sub(r"[ ().-]", "", t),
    lambda t: re.sub(r"[ ().-]+", " ", t).strip(),
    lambda t: t.upper(),
)


def examples(text: str, rng: random.Random) -> tuple[list[str], list[int], list[bool]]:
    """A document's candidates and labels; base spans as they are, and some of them again, rewritten, as free tokens. What
    has the normal form of a base span is taken to be the same entity."""
    base = base_spans(text)
    of = {x: k for k, own in enumerate(base) for x in own}
    forms = {normal(text[a:b]): k for (a, b), k in of.items()}
    tokens, labels, sure = [], [], []
    for x in tokens_of(text, base):
        k = of.get(x, NONE)
        if k == NONE and any(x[0] < b and a < x[1] for a, b in of):
            continue  # overlapping kinds
        t = text[x[0] : x[1]]
        tokens.append(t)
        labels.append(forms.get(normal(t), NONE))
        sure.append(k != NONE and rng.random() < 0.5)
        if k != NONE and rng.random() < 0.7:
            tokens.append(rng.choice(REWRITES)(t) if k != 1 else t)
            labels.append(k)
            sure.append(False)
    return tokens, labels, sure


def fitted(texts: list[str], rounds: int = 8, seed: int = 5) -> tuple[dict[tuple[str, int], float], tuple[float, float, float]]:
    """Averaged perceptron weights of features and of the three pair potentials (chain, same form, alike). Without texts
    nothing is learned and nothing is added."""
    rng = random.Random(seed)
    w: dict[tuple[str, int], float] = {}
    total: dict[tuple[str, int], float] = {}
    pair, pair_total = np.array([0.0, 1.0, 0.2]), np.zeros(3)
    left = rounds * len(texts)
    for _ in range(rounds):
        for text in texts:
            left -= 1
            tokens, labels, sure = examples(text, rng)
            if not tokens:
                continue
            gold, known = np.array(labels), np.array(sure)
            own, above = groups_of(tokens)
            scores = np.stack([unary(t, w) for t in tokens])
            scores[known] = -1e3
            scores[known, gold[known]] = 1e3
            got = decoded(scores, known, own, above, tuple(pair))
            for t, g, k in zip(tokens, gold, got, strict=True):
                if g != k:
                    for f in features(t):
                        for key, by in (((f, int(g)), 1.0), ((f, int(k)), -1.0)):
                            w[key] = w.get(key, 0.0) + by
                            total[key] = total.get(key, 0.0) + by * (left + 1)
            agree = lambda y: np.array([(y[1:] == y[:-1]).sum(), same(y, own), same(y, [above[i] for i in own])], float)
            pair = np.clip(pair + 0.02 * (agree(gold) - agree(got)), (0.0, 0.5, 0.0), (0.5, 4.0, 1.0))
            pair_total += pair
    n = max(1, rounds * len(texts))
    return {k: v / n for k, v in total.items()}, tuple((pair_total / n).tolist())


def same(labels: np.ndarray, group: list[int]) -> int:
    """Members that agree with the one before them in their group."""
    last: dict[int, int] = {}
    n = 0
    for k, g in zip(labels.tolist(), group, strict=True):
        n += last.get(g) == k
        last[g] = k
    return n


def trained(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple:
    """The weights of a bounded sample of the documents (doc_id, text) that may hold a base span."""
    texts: list[str] = []
    share = min(1.0, POOL / max(1, docs.count()))
    docs = docs.withColumn("h", F.xxhash64("doc_id", "text")).where(F.col("h") / F.lit(2.0**63) <= 2 * share - 1)
    for pattern in (r"[0-9]@|@[A-Za-z0-9-]+\.|[0-9]+\.[0-9]+\.[0-9]+\.[0-9]|\+[0-9]|[0-9]{4}[ -]?[0-9]{4}", "[0-9@]"):
        some = docs.where((F.length("text") <= TRAIN_CHARS) & F.col("text").rlike(pattern))
        some = some.select("h", "text").orderBy("h", "text").limit(train_docs)
        texts += [r.text for r in some.toLocalIterator()]
    return fitted(texts)


def added(text: str, base: list[list[tuple[int, int]]], model: tuple) -> list[list[tuple[int, int]]]:
    """Spans of candidates that the field labels with a kind and that touch no base span."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    weights, pair = model
    spans = tokens_of(text, base) if weights else []
    if not spans:
        return out
    taken = sorted((a, b, k) for k in range(NONE) for a, b in base[k])
    tokens = [text[a:b] for a, b in spans]
    scores, clamped, p = np.stack([unary(t, weights) for t in tokens]), np.zeros(len(spans), bool), 0
    for i, (a, b) in enumerate(spans):
        while p < len(taken) and taken[p][1] <= a:
            p += 1
        if p < len(taken) and taken[p][0] < b:  # the patterns are certain
            scores[i], clamped[i] = -1e3, True
            scores[i, taken[p][2]] = 1e3
    if not clamped.all():
        labels = decoded(scores, clamped, *groups_of(tokens), pair)
        for i in np.flatnonzero(~clamped & (labels != NONE)).tolist():
            out[labels[i]].append(spans[i])
    return out


def joined(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, own in zip(KINDS, spans, strict=True) for a, b in own])


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: tuple | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (of the base patterns), base_sha256, spans (base and added) and n_added.

    A null text is an empty one, without spans. A very long digit run is one candidate and is scanned once. The weights
    are fitted on a bounded sample of the documents unless they are given (as by trained()); without any base span in it
    nothing is added. Nothing else is shuffled; the weights that are shipped are a few hundred numbers.
    """
    docs = pick(docs, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast(model or trained(docs))

    def row(model: tuple, doc_id: int | None, text: str | None) -> tuple:
        text = text or ""
        base = base_spans(text)
        more = added(text, base, model)
        every = [sorted(b + m) for b, m in zip(base, more, strict=True)]
        digest = hashlib.sha256(joined(base).encode()).hexdigest()
        return doc_id, *map(len, base), digest, joined(every), sum(map(len, more))

    return mapped(
        docs, row,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long",
        lambda: held.value,
    )
