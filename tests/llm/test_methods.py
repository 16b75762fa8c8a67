"""Each operator against a plain version, an exact round trip or held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from quillon.llm import op2_licenses, op3_pii, op4_lines, op5_katz, op6_quality, op7_decontaminate, op8_suffixes, op9_pieces, op10_minhash
from quillon.llm.op1_toxicity import Model, Scores, score_of
from quillon.llm.queries import tokenizer

from . import brute

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{DATA}/documents.parquet").to_pylist()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_toxicity_held_out():
    table = pq.read_table("/root/testdata/sf0.1/documents.parquet").to_pydict()
    toxic = dict(zip(*[pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pydict()[c] for c in ("doc_id", "toxic")], strict=True))
    own = [(i, t) for i, t in zip(table["doc_id"], table["text"], strict=True) if i in toxic]
    train = [(i, t) for i, t in own if zlib.crc32(str(i).encode()) % 5]
    test = [(i, t) for i, t in own if not zlib.crc32(str(i).encode()) % 5]
    numbers, constant = Model([t for _, t in train], [toxic[i] for i, _ in train]).numbers()
    scores = Scores(numbers)
    s, y = np.array([score_of(scores, constant, t) for _, t in test]), np.array([toxic[i] for i, _ in test])
    rank = s.argsort().argsort()
    assert (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5 > 0.8
    assert (s[y == 0] >= 0.5).mean() < 0.03
    assert (s[y == 1] >= 0.5).mean() > 0.5


def test_misspelling_shares_vectors():
    texts = ["you are an idiot friend", "a calm and sunny day"] * 40
    numbers, constant = Model(texts, [1, 0] * 40, examples=4000).numbers()
    scores = Scores(numbers)
    assert score_of(scores, constant, "what an idiott") > score_of(scores, constant, "what a sunnny day")


def test_licenses():
    index = op2_licenses.Index(op2_licenses.TEMPLATES)
    for name, texts in op2_licenses.TEMPLATES.items():
        for t in texts:
            found = index.scan(f"some words before {t} and some after")
            assert found[0][:2] == (name, 1.0)
    changed = op2_licenses.TEMPLATES["BSD"][0].replace("source and", "source code and").replace("following ", "")
    assert index.scan(changed)[0][1] > 0.9
    assert index.scan("nothing of the kind is here at all") == []


def common(a, b):
    """Length of the longest common subsequence, without a band."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b, 1):
            new.append(row[k - 1] + 1 if x == y else max(row[k], new[-1]))
        row = new
    return row[-1]


def test_alignments_against_an_unbanded_one():
    """Random edits of templates, one or two in a text: found if enough is left, with as many matched words."""
    rng = random.Random(6)
    templates = {f"L{k}": (" ".join(f"w{rng.randrange(60)}" for _ in range(rng.choice((12, 30, 80)))),) for k in range(8)}
    index = op2_licenses.Index(templates)
    sure = 0
    for _ in range(300):
        parts, want = [], []
        for name in rng.sample(sorted(templates), rng.choice((1, 2))):
            w = op2_licenses.words(templates[name][0])
            new, drift = [], 0
            for x in w:
                what = rng.random()
                if what < 0.04:
                    new.append(b"changed")
                elif what < 0.06 and drift < 3:
                    drift += 1
                elif what < 0.08 and drift < 3:
                    new += [b"more", x]
                    drift += 1
                else:
                    new.append(x)
            parts += [b"z%d" % rng.randrange(10**6) for _ in range(40)] + new
            want.append((name, w, new))
        text = b" ".join(parts).decode()
        found = index.scan(text)
        for name, coverage, n, lo, hi in found:
            assert n == round(coverage * len(op2_licenses.words(templates[name][0]))) and n <= common(op2_licenses.words(templates[name][0]), op2_licenses.words(text)[lo:hi])
        for name, w, new in want:
            n = common(w, new)
            stretches = {tuple(w[k : k + op2_licenses.GUARANTEE]) for k in range(len(w))} & {tuple(new[k : k + op2_licenses.GUARANTEE]) for k in range(len(new))}
            if n >= op2_licenses.COVERAGE * len(w) and stretches:
                sure += 1
                assert any(f[0] == name and f[2] >= n for f in found)
    assert sure > 200


def test_base_spans():
    rng = random.Random(1)

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(d[::-1])) % 10 == 0

    def plain(t):
        digits = lambda m: re.sub("[^0-9]", "", m[0])
        return [
            [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
            [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))],
            [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
            [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15],
        ]

    for _ in range(5000):
        t = "".join(rng.choice("0123456789..--++@@ab ()%_ ") for _ in range(rng.randint(0, 40)))
        assert op3_pii.base_spans(t) == plain(t)


def test_messages_make_labels_agree():
    scores = np.array([[0.0, 0.0, 0.0, 3.0, 0.0], [0.0, 0.0, 0.0, 0.9, 1.0], [0.0, 0.0, 0.0, 0.0, 2.0]])
    free = np.zeros(3, bool)
    assert op3_pii.decoded(scores, free, [0, 1, 2], [0, 1, 2], (0.0, 1.0, 1.0)).tolist() == [3, 4, 4]
    assert op3_pii.decoded(scores, free, [0, 0, 1], [0, 1], (0.0, 1.0, 1.0)).tolist() == [3, 3, 4]


@pytest.mark.parametrize("k", [2, 3, 6, 8, 16, 33, 64, 500])
def test_repeats_of_a_certain_token_get_its_label(k):
    """All but one prefer none by a little; wherever the certain one stands, all agree with it."""
    for at in {0, k // 2, k - 1}:
        scores, clamped = np.zeros((k, 5)), np.zeros(k, bool)
        scores[:, 4] = 0.05
        scores[at], clamped[at] = -1e3, True
        scores[at, 3] = 1e3
        assert (op3_pii.decoded(scores, clamped, [0] * k, [0], (0.05, 1.0, 0.2)) == 3).all()


def test_the_best_labels_of_small_fields():
    """Chain and groups against all labellings: the messages find one of the best score on trees."""
    rng = np.random.default_rng(4)
    for _ in range(50):
        n, pair = 5, (0.0, float(rng.uniform(0.2, 2)), 0.0)
        scores = rng.normal(0, 1, (n, 5))
        got = op3_pii.decoded(scores, np.zeros(n, bool), [0, 0, 0, 1, 1], [0, 1], pair)
        value = lambda y: scores[np.arange(n), y].sum() + max(pair[1] * sum(y[i] == g for i in (0, 1, 2)) for g in range(5)) + max(pair[1] * sum(y[i] == g for i in (3, 4)) for g in range(5))
        assert math.isclose(value(got), max(value(np.array(y)) for y in itertools.product(range(5), repeat=n)))


def test_rewritten_repeats_are_added(spark):
    """A model of the documents of sf0.1 finds repeats of personal data that lost a prefix, their case or their separators."""
    model = op3_pii.trained(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text"))
    texts = {
        1: "call +1 (222) 555-1234 or 222-555-1234 or 222 555 1234 or 2225551234 please",
        2: "john.12@mail.org 1 (222) 555-1234 +1 (222) 555-1234",
        3: "in 2019 there were 300 of 12.5 and 1,200 more at 10:30",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in op3_pii.found(df, model=model).collect()}
    assert (got[1].n_phone, got[1].n_added) == (1, 3) and (got[2].n_email, got[2].n_phone, got[2].n_added) == (1, 1, 1) and got[3].n_added == 0


def test_lines(spark, docs, rows):
    small = [(i, t) for i, t in rows if t.count("\n") < 60]
    got = {r.doc_id: r.runs for r in op4_lines.report(docs.where("length(text) - length(replace(text, '\n', '')) < 60")).collect()}
    want = brute.repeated_lines(small)
    assert {i: sorted(k for s in filter(None, r.split(",")) for k in range(*map(int, s.split(":")))) for i, r in got.items()} == want
    assert any(want.values())


def test_katz(docs, rows):
    """The same probabilities from dictionaries; after each word they add up to 1."""
    got = {r.doc_id: r for r in op5_katz.scored(docs, order=2).collect()}
    words = {i: [*brute.words(t), "\n"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in words}
    one, two = Counter(), defaultdict(Counter)
    for i, w in words.items():
        if not held[i]:
            one.update(w)
            for a, b in zip(["<s>", *w], w, strict=False):
                two[a][b] += 1
    total, k = sum(one.values()), op5_katz.K

    def hist(values):
        n = Counter(values)
        return np.array([0.0, *[n[r] for r in range(1, k + 2)]])

    d1, d2 = op5_katz.discounts(hist(one.values())), op5_katz.discounts(hist(v for h in two.values() for v in h.values()))
    unknown = 1 - sum(d1[min(c, k + 1)] * c for c in one.values()) / total
    p1 = lambda w: d1[min(one[w], k + 1)] * one[w] / total if one[w] else unknown

    def after(h):
        seen = two[h]
        c = sum(seen.values())
        p = {w: d2[min(n, k + 1)] * n / c for w, n in seen.items()}
        left = 1 - sum(p.values())
        if left < 1e-12:
            p = {w: x * c / (c + 0.5) for w, x in p.items()}
            left = 0.5 / (c + 0.5)
        return p, left / (1 - sum(p1(w) for w in seen))

    p, weight = after("<s>")
    assert math.isclose(sum(p.values()) + weight * (unknown + sum(p1(w) for w in one if w not in p)), 1)
    known = {h: after(h) for h in list(two)}
    for i, w in words.items():
        s = 0.0
        for h, x in zip(["<s>", *w], w, strict=False):
            p, weight = known.get(h, ({}, 1.0))
            s += math.log10(p.get(x) or weight * p1(x))
        r = got[i]
        assert math.isclose(r.score, s, rel_tol=1e-9) and r.n_tokens == len(w) and r.train_tokens == total and r.held_out == held[i]
        base = sum(math.log10((one[x] + 0.5) / (total + 0.5 * (len(one) + 1))) for x in w)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.n_known == sum(x in one for x in w)


def spelled(got):
    return {i: sorted(k for s in filter(None, r.split(",")) for k in range(*map(int, s.split(":")))) for i, r in got.items()}


def test_lines_of_whole_texts(docs, rows):
    got = {r.doc_id: r.runs for r in op4_lines.report(docs).collect()}
    assert spelled(got) == brute.repeated_lines(rows)


def test_random_lines(spark):
    """Few different lines, some of them in most documents, in runs that repeat, overlap and touch."""
    rng = random.Random(8)
    lines = [" ".join(rng.choice("abcdefghijkl") for _ in range(rng.choice((1, 2, 5, 9, 20, 60)))) for _ in range(40)]
    runs = [[rng.choice(lines) for _ in range(rng.randint(2, 30))] for _ in range(12)]
    rows = [(i, "\n".join(x for _ in range(rng.randint(1, 6)) for x in (rng.choice(runs) if rng.random() < 0.6 else [rng.choice(lines), lines[0]]))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.repeated_lines(rows)
    assert spelled({r.doc_id: r.runs for r in op4_lines.report(df).collect()}) == want and sum(map(len, want.values())) > 100
    found = [w for _, t in rows for w in op4_lines.windows(op4_lines.lines_of(t), 50)]
    assert len(found) < sum(len(w) for *_, w in found)


@pytest.mark.parametrize("order", [3, 4])
def test_katz_of_higher_orders(docs, rows, order):
    """The recursion over dictionaries gives the same scores; after a hundred histories of each length they add up to 1."""
    model = brute.Katz(rows, order)
    got = {r.doc_id: r.score for r in op5_katz.scored(docs, order).collect()}
    assert all(math.isclose(got[i], model.score(t), rel_tol=1e-9) for i, t in rows)
    rng = random.Random(3)
    for n in range(1, order):
        for h in rng.sample(sorted(model.seen[n + 1]), 100):
            assert math.isclose(sum(model.p(h, w) for w in model.one) + model.p(h, None), 1)


def test_crowded_last_words_of_histories(docs, rows, monkeypatch):
    """Dealing the histories of frequent words by the word before as well changes nothing."""
    monkeypatch.setattr(op5_katz, "BUCKET", 400)
    monkeypatch.setattr(op5_katz, "MOST", 400)
    model = brute.Katz(rows, 3)
    got = {r.doc_id: r.score for r in op5_katz.scored(docs).collect()}
    assert all(math.isclose(got[i], model.score(t), rel_tol=1e-9) for i, t in rows)


def test_quality(docs, rows):
    got = {r.doc_id: r for r in op6_quality.judged(docs).collect()}
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(t)


def test_frequent_lines(spark):
    line = "click here to read all of the terms of this site today"
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    rows = [(i, f"{line} {i % 10}\n{body(i)}", "h") for i in range(60)] + [(100 + i, f"{line} 5\nshort w{i}", "h") for i in range(5)] + [(200, f"{line} 5\n{body(200)}", "other")]
    got = {r.doc_id: (r.kept, r.n_removed_words) for r in op6_quality.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i] == (True, 13) for i in range(60)) and not any(got[100 + i][0] for i in range(5)) and got[200] == (True, 0)


def test_frequent_lines_of_copies_and_hosts_of_any_size(spark):
    """The line is on a fifth of each host's documents: near copies, or exact ones, in a host of 50 and of 1,000."""
    line = "click here to read all of the terms of this site today"
    body = lambda i: " ".join(f"w{i}x{k}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(30))
    rows, want = [], {}
    for h, (n, exact) in enumerate([(50, False), (50, True), (1000, False), (1000, True)]):
        for k in range(n):
            i, on = 10_000 * h + k, k % 5 == 0
            rows.append((i, f"{line}\n{body(h if exact else i)}" if on else body(i), f"h{h}"))
            want[i] = (not on, 42) if on and exact else (True, 12 if on else 0)
    rows.append((90_000, f"{line}\n{body(90_000)}", "small"))
    want[90_000] = (True, 0)
    got = {r.doc_id: (r.kept, r.n_removed_words) for r in op6_quality.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == want


def test_automaton():
    rng = random.Random(3)
    for _ in range(300):
        items = [(i, [rng.choice("abcd").encode() for _ in range(rng.choice([1, 2, 3, 5, 8, 20, 30]))]) for i in range(rng.randint(1, 5))]
        doc = [rng.choice("abcdz").encode() for _ in range(30)] + items[0][1] + [rng.choice("abcdz").encode() for _ in range(30)]
        hit, who = set(), set()
        for i, q in items:
            k = min(13, len(q))
            for a in range(len(q) - k + 1):
                for b in range(len(doc) - k + 1):
                    if q[a : a + k] == doc[b : b + k]:
                        who.add(i)
                        hit.update(range(b, b + k))
        spans, items_found = op7_decontaminate.Automaton(items, 13).hits(doc)
        assert {k for a, b in spans for k in range(a, b)} == hit and items_found == who


def test_item_blocks_agree(spark, docs):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    a, b = (sorted(map(str, op7_decontaminate.contamination(docs, items, block_words=n).collect())) for n in (10**6, 50))
    assert a == b


@pytest.mark.parametrize("words", [10**6, 2500])
def test_contamination_of_whole_tables(spark, docs, rows, words):
    """Every column of every document against plain windows, in one pass and in several, with ids that are no numbers."""
    items = [(f"item {r['item_id']}", r["text"]) for r in pq.read_table(f"{DATA}/benchmark.parquet").to_pylist()]
    got = op7_decontaminate.contamination(docs, spark.createDataFrame(items, "item_id string, text string"), pass_words=words).collect()
    want = brute.contamination(rows, items)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == want
    assert any(w[4] for w in want.values())


def test_share_is_taken_as_written(spark):
    docs = spark.createDataFrame([(1, "a b " + "x " * 23), (2, "a b " + "x " * 24)], "doc_id long, text string")
    got = op7_decontaminate.contamination(docs, spark.createDataFrame([(1, "a b")], "item_id long, text string"), share=0.08).collect()
    assert {r.doc_id: r.contaminated for r in got} == {1: True, 2: False}


def test_suffix_array():
    rng = np.random.default_rng(1)
    for n in [*range(1, 40), 200, 201, 202]:
        for top in (1, 2, 5):
            s = rng.integers(1, top + 1, n)
            assert op8_suffixes.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("spread", [1000, 1])
def test_suffixes(docs, rows, monkeypatch, spread):
    monkeypatch.setattr(op8_suffixes, "SPREAD", spread)
    monkeypatch.setattr(op8_suffixes, "BLOCK", 60_000)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op8_suffixes.deduplicated(docs).collect()}
    assert got == brute.repeated_bytes(rows)


def test_pieces_equal_the_library(rows):
    import sentencepiece

    model = tokenizer()
    lib, own = sentencepiece.SentencePieceProcessor(model_file=model), op9_pieces.Pieces(open(model, "rb").read())
    rng = random.Random(1)
    texts = [t for _, t in rows] + ["".join(rng.choice("ab  ▁\n\té漢😀\x00éthines012,.　�<s>") for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    for t in texts:
        ids = lib.encode(t)
        assert own.encode(t) == ids
        assert own.decode(ids) == own.digest(t)[2] == lib.decode(ids)


def test_near_duplicates(docs, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op10_minhash.duplicates(docs, words=2).collect()}
    assert got == brute.near_duplicates(rows)


def test_links_that_the_first_star_misses(spark):
    """A chain of changes: neighbours are linked, ends are not, and all are one component."""
    base = [f"w{k}" for k in range(100)]
    rows = [(10 + i, " ".join(f"v{k}" if k < 3 * i else w for k, w in enumerate(base))) for i in range(10)]
    got = {r.doc_id: r.component_id for r in op10_minhash.duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=1).collect()}
    assert got == {i: c for i, (_, c) in brute.near_duplicates(rows, 1).items()}


def test_families_on_both_sides_of_the_limit(spark):
    """Copies of a few texts that differ from them in 2 to 16 % of the words, so that most pairs are near the limit and many
    are linked through others alone: the same components as by comparing all pairs."""
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for _ in range(4):
        base = [word() for _ in range(rng.choice((20, 60, 140)))]
        chain = base
        for _ in range(90):
            share = rng.uniform(0.02, 0.16)
            own = [word() if rng.random() < share / 2 else x for x in (chain if rng.random() < 0.3 else base)]
            if rng.random() < 0.3:
                own = own[: len(own) - rng.randrange(len(own) // 6 + 1)]
            chain = own
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.near_duplicates(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op10_minhash.duplicates(df, words=2).collect()} == want
    assert 8 < len({c for _, c in want.values()}) < 300


def test_exact_fraction_of_the_similarity():
    assert op10_minhash.fraction(0.8) == (4, 5) and op10_minhash.fraction(0.85) == (17, 20) and op10_minhash.fraction(1.0) == (1, 1)
    with pytest.raises(ValueError):
        op10_minhash.fraction(0.0)


def test_repeated_rows_of_long_texts(spark):
    """Rows that repeat an id and its text get one row each, with the same answer; they remove nothing from each other."""
    t = " ".join(f"w{k}" for k in range(80))
    rows = [(4, t), (4, t), (5, "x " + t), (6, t), (6, "other-" + t)]
    got = op8_suffixes.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in got) == [(4, len(t), 0), (4, len(t), 0), (5, len(t) + 2, len(t)), (6, len(t), len(t)), (6, len(t) + 6, len(t))]


def test_entry_registers_all():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
