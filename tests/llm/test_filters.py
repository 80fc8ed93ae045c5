"""Toxicity, quality, licences, url rules and chat renderings on small cases."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, docs, invented, labels

from berth.llm import chat, licenses, quality, toxicity, url_filter


def held_out(doc_id, folds, fold):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


@pytest.fixture(scope="module")
def learned(spark):
    rows, marks = invented(600)
    return docs(spark, rows), labels(spark, marks), {m[0]: m for m in marks}


@pytest.mark.parametrize(
    ("module", "label", "folds", "fold"), [(toxicity, 2, 5, 0), (quality, 1, 3, 1)]
)
def test_held_out_accuracy(spark, learned, module, label, folds, fold):
    given, marks, truth = learned
    model = module.fit(given, marks)
    rows = module.score(given, model).collect()
    assert len(rows) == 600
    assert all(r.held_out == held_out(r.doc_id, folds, fold) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    right = [r.predicted == truth[r.doc_id][label] for r in rows if r.held_out]
    assert np.mean(right) > 0.95
    # The edge cases get a score too, in a table with clashing names.
    edges = module.score(docs(spark), model).collect()
    assert Counter(r.doc_id for r in edges) == Counter(i for i, _ in TEXTS)
    assert all(0 <= r.score <= 1 for r in edges)
    same = {r.score for r in edges if r.doc_id in (1, 2, 8)}
    assert len(same) == 1


@pytest.mark.parametrize("module", [toxicity, quality])
def test_labels_of_the_held_out_fold_teach_nothing(spark, learned, module):
    given, marks, truth = learned
    folds, fold = (5, 0) if module is toxicity else (3, 1)
    turned = [
        (i, 1 - q, 1 - t) if held_out(i, folds, fold) else (i, q, t) for i, q, t in truth.values()
    ]
    one, two = (
        {r.doc_id: r.score for r in module.score(given, module.fit(given, m)).collect()}
        for m in (marks, labels(spark, turned))
    )
    assert one == pytest.approx(two)


@pytest.mark.parametrize(
    ("module", "keep", "score"),
    [(toxicity, toxicity.keep_ordinary, 0.0), (quality, quality.keep_good, 1.0)],
)
def test_without_labels_or_texts(spark, module, keep, score):
    none = labels(spark, []).limit(0)
    model = module.fit(docs(spark), none)
    assert {r.score for r in module.score(docs(spark), model).collect()} == {score}
    kept = keep(docs(spark), model)
    assert kept.columns == docs(spark).columns
    assert kept.count() == len(TEXTS)
    empty = docs(spark).limit(0)
    model = module.fit(empty, none)
    assert module.score(empty, model).collect() == []
    # Labels of one kind, null labels, labels of no document, two labels of one id.
    odd = labels(spark, [(1, 1, 0), (1, 1, 0), (None, 0, 1), (2, None, None), (99, 0, 1)])
    model = module.fit(docs(spark), odd)
    assert {r.score for r in module.score(docs(spark), model).collect()} == {score}


def test_filters_keep_whole_rows(spark, learned):
    given, marks, truth = learned
    kept = toxicity.keep_ordinary(given, toxicity.fit(given, marks))
    assert kept.columns == given.columns
    ids = {r.doc_id for r in kept.collect()}
    clean = {i for i, _, t in truth.values() if not t}
    assert len(clean & ids) > 0.97 * len(clean)
    assert len(ids - clean) < 0.05 * len(truth)


def test_many_common_trigrams_leave_the_class_conditional_ones(spark):
    # About half a million n-grams of the shared orders, and three toxic expressions.
    draw = np.random.default_rng(6)
    rare = {"".join(map(chr, row)) for row in draw.integers(0x4E00, 0x9FA5, (110_000, 3))}
    rows = [(w.encode(), 2, 0) for w in rare] + [(w, 0, 9) for w in (b"gronk", b"snarf", b"vlurg")]
    columns = [pa.array(c) for c in zip(*rows, strict=True)]
    words = spark.createDataFrame(pa.table(columns, ["word", "ordinary", "toxic"]))
    model = toxicity.fit_counts(words)
    assert model.deltas([b"gronk", b"snarf"]).min() > 1


def test_an_expression_counts_the_same_wherever_it_stands_in_its_batch(spark):
    words = [(b"gronk", 0, 9), (b"gronks", 0, 4), (b"table", 9, 0), (b"tables", 5, 1)]
    model = toxicity.fit_counts(spark.createDataFrame(words, "word binary, ordinary long, toxic long"))
    asked = [w for w, _, _ in words]
    assert model.deltas(asked).tolist() == model.deltas(asked[::-1])[::-1].tolist()
    assert model.deltas(asked).tolist() == [model.deltas([w])[0] for w in asked]


def test_each_n_gram_of_an_expression_is_looked_up_once(spark, monkeypatch):
    words = [(b"gronk", 0, 9), (b"table", 9, 0)]
    model = toxicity.fit_counts(spark.createDataFrame(words, "word binary, ordinary long, toxic long"))
    asked, find = [], toxicity.Table.find
    monkeypatch.setattr(toxicity.Table, "find", lambda self, keys: asked.append(len(keys)) or find(self, keys))
    assert model.deltas([b"gronk"])[0] > 1
    # The empty context, and the n-grams of seven characters with the two marks.
    assert sum(asked) <= 1 + sum(8 - n for n in range(1, toxicity.ORDER + 1))


def test_n_grams_are_counted_as_by_plain_search(spark):
    given = [("ab", 3, 0), ("aba", 0, 2), ("abab", 4, 1), ("x" * 50, 1, 1), ("漢字", 2, 0), ("a", 1, 1)]
    upper, lower = Counter(), {}
    for word, *counts in given:
        for k in range(0, len(word), toxicity.LONGEST):
            marked = f"\n{word[k : k + toxicity.LONGEST]}\n"
            for end in range(2, len(marked) + 1):
                for n in range(1, min(toxicity.ORDER, end) + 1):
                    gram = marked[end - n : end]
                    if n <= toxicity.SHARED:
                        lower.setdefault(gram, set()).add(marked[end - n - 1 : end] if end > n else "")
                    else:
                        upper.update({(gram, c): v for c, v in enumerate(counts)})
    words = spark.createDataFrame(
        [(w.encode(), *c) for w, *c in given], "word binary, ordinary long, toxic long"
    )
    up, low = (df.collect() for df in toxicity.gram_counts(words))
    assert Counter((r.n, r.ordinary, r.toxic) for r in up) == Counter(
        (len(g), upper[g, 0], upper[g, 1]) for g in {g for g, _ in upper}
    )
    assert Counter((r.n, r.types) for r in low) == Counter((len(g), len(s)) for g, s in lower.items())


def test_only_the_texts_of_the_curve_are_left_out_of_the_counts(spark, learned, monkeypatch):
    given, marks, truth = learned
    counted, count = [], toxicity.word_counts
    monkeypatch.setattr(toxicity, "SAMPLE", 5)
    monkeypatch.setattr(toxicity, "word_counts", lambda rows: counted.append(rows.count()) or count(rows))
    assert toxicity.fit(given, marks).known
    assert counted == [sum(not held_out(i, 5, 0) for i in truth) - 10]


def test_descent_finds_the_optimum():
    # Compare with a long run of plain subgradient steps on the same objective.
    draw = np.random.default_rng(1)
    rows = [np.unique(draw.integers(0, 20, 6)) for _ in range(60)]
    scale = draw.normal(size=20)
    y = np.where(np.array([scale[r].sum() for r in rows]) + draw.normal(size=60) > 0, 1, -1)
    weight, bias = quality.descend(rows, y, scale, cost=0.1, epochs=300)
    upper = np.where(y > 0, 30 / (y > 0).sum(), 30 / (y < 0).sum()) * 0.1
    x = np.zeros((60, 21))
    for k, r in enumerate(rows):
        x[k, r] = scale[r]
    x[:, 20] = 1

    def loss(w):
        return w @ w / 2 + (upper * np.maximum(0, 1 - y * (x @ w))).sum()

    best, w = np.inf, np.zeros(21)
    for step in range(1, 20_000):
        inside = y * (x @ w) < 1
        w = w - (w - ((upper * y)[inside, None] * x[inside]).sum(axis=0)) / step
        best = min(best, loss(w))
    assert loss(np.append(weight, bias)) <= best + 1e-3


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_licences_against_plain_search(spark):
    rows = {}
    for r in licenses.scan(docs(spark)).collect():
        rows.setdefault(r.doc_id, r)
    assert licenses.scan(docs(spark).limit(0)).collect() == []
    for doc_id, text in TEXTS:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = WORD.findall(low)
        found = [
            (i, label)
            for phrase, label in licenses.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        r = rows[doc_id]
        assert (r.n_words, r.n_base) == (len(words), len(found))
        assert r.first_word == min((i for i, _ in found), default=None)
        assert r.last_word == max((i for i, _ in found), default=None)
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_matching_statistics_against_brute_force():
    own = licenses.automaton()
    templates = [licenses.words_of(t) for _, t in licenses.TEMPLATES]
    draw = np.random.default_rng(2)
    for _ in range(150):
        words = []
        for _ in range(draw.integers(1, 5)):
            t = templates[draw.integers(len(templates))]
            a = draw.integers(len(t))
            words += t[a : a + draw.integers(1, 14)]
            words += [b"zz"] * draw.integers(0, 2)
        runs = set()
        for stop in range(1, len(words) + 1):
            # The longest run that ends here and stands in a template or a phrase.
            for start in range(stop):
                run = words[start:stop]
                if any(run == t[k : k + len(run)] for t in templates for k in range(len(t))):
                    runs.add((start, stop))
                    break
        longest = {(a, b) for a, b in runs if (a, b + 1) not in runs and b - a >= licenses.LONG}
        assert {(m.start, m.start + m.length) for m in own.scan(words)[1]} == longest


def test_templates_are_found_whole_and_with_gaps():
    for label, text in licenses.TEMPLATES:
        assert licenses.scan_text(f"x {text} y")[5:] == (licenses.scan_text(text)[5], 1.0)
        assert label in licenses.scan_text(text)[5].split(",")
        words = text.split()
        words.insert(len(words) // 2, "something else between")
        assert licenses.scan_text(" ".join(words))[6] > 0.9


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("block", "net", "/es"),
         ("block", "b.net", ""), ("allow", "b.net", ""), ("block", None, "/x")]
URLS = ["http://example.com/en/1", "https://WWW.Example.COM/en/", "http://example.com", None, "", "no url",
        "ftp://x.net/espana?q=1", "http://net/es", "http://b.net", "http://a.b.net/?x", "http://com/", "://",
        "http://badexample.com/en/", "http://x.com/a\nb#c", "http:///en/", "http://a..com/q"]


def judged(rules, url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [
        (len(h + p), len(h), h + p)
        for _, h, p in rules
        if h is not None and host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    rule = max(fit)[2] if fit else None
    blocked = rule is not None and any(v == "block" and h is not None and h + p == rule for v, h, p in rules)
    return host, path, rule, "block" if blocked else "allow"


@pytest.mark.parametrize("joined", [False, True])
def test_url_rules_against_plain_matching(spark, monkeypatch, joined):
    if joined:
        monkeypatch.setattr(url_filter, "MOST_BITS", 1)
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(URLS * 2)], "page_id long, url string, host int, rule int")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    rows = {r.page_id: tuple(r)[1:] for r in url_filter.judge(pages, rules).collect()}
    assert rows == {i: judged(RULES, u) for i, u in enumerate(URLS * 2)}
    assert url_filter.judge(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in url_filter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(3000).selectExpr("concat('k', id) AS key")
    listed = universe.where("hash(key) % 5 = 0")
    levels = url_filter.build_cascade(listed, universe)
    assert len(levels) > 2
    told = universe.select("key", url_filter.in_cascade(levels, universe["key"]).alias("told"))
    assert {r.key for r in told.where("told").collect()} == {r.key for r in listed.collect()}


def test_rotation_edges(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann b", "hi <|im_end|> x"), (1, 2, "bob", None),
             (1, 2, "bob", None), (1, None, None, "who"), (None, 0, "bob", "lost"), (2, 0, "system", "alone")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS name", "2 AS perspective", "3 AS speaker")
    rows = chat.rotate(df).collect()
    assert len(rows) == 5 * 3 + 1
    assert {r.perspective for r in rows if r.conv_id == 1} == {"ann_b", "bob", "unnamed"}
    for r in rows:
        learned = r.rendered[r.learn_from : r.learn_to]
        assert r.rendered.count("<|im_start|>") == r.rendered.count("<|im_end|>") == 1
        assert learned.endswith("<|im_end|>") if r.role == "assistant" else learned == ""
        assert (r.name is not None) == (r.role == "user")
    assert chat.rotate(df.limit(0)).collect() == []


def rare(n, few, seed):
    """n ordinary texts of invented words, of which the first few outside both folds hold a word
    that gives them away; their labels say so."""
    import random

    draw = random.Random(seed)
    words = ["".join(draw.choice(["ba", "lo", "ti", "ner", "su", "mek"]) for _ in range(draw.randint(1, 4)))
             for _ in range(300)]
    texts = [" ".join(draw.choices(words, k=40)) for _ in range(n)]
    bad = [i for i in range(n) if not held_out(i, 5, 0) and not held_out(i, 3, 1)][:few]
    told = {i: f"{t} GRONKSNARF!! gronksnarf {t} gronksnarf" for i, t in enumerate(texts) if i in bad}
    return [(i, told.get(i, t)) for i, t in enumerate(texts)], bad


def test_four_toxic_labels_are_enough_to_tell(spark):
    rows, bad = rare(200, 4, 3)
    marks = [(i, 1, int(i in bad)) for i, _ in rows]
    assert 199 not in bad
    rows += [(1000, rows[199][1] + " gronksnarf gronksnarf"), (1001, rows[199][1])]
    model = toxicity.fit(docs(spark, rows), labels(spark, marks))
    assert model.known
    found = {r.doc_id: r.score for r in toxicity.score(docs(spark, rows), model).collect()}
    clean = [s for i, s in found.items() if i not in bad and i != 1000]
    assert min(found[i] for i in bad) > max(clean) and found[1000] > np.median(clean)


@pytest.mark.parametrize("seed", range(3))
def test_a_rare_class_is_in_the_sample(spark, monkeypatch, seed):
    monkeypatch.setattr(quality, "SAMPLE", 20)
    rows, bad = rare(300, 4, seed)
    marks = [(i, int(i not in bad), 0) for i, _ in rows]
    model = quality.fit(docs(spark, rows), labels(spark, marks))
    assert model.known
    found = {r.doc_id: r.score for r in quality.score(docs(spark, rows), model).collect()}
    assert max(found[i] for i in bad) < np.median([s for i, s in found.items() if i not in bad])


def test_cascades_do_not_grow_with_the_universe(spark, monkeypatch):
    listed = spark.range(5).selectExpr("concat('k', id) AS key")
    sizes = []
    for n in (1000, 30_000):
        universe = spark.range(n).selectExpr("concat('k', id) AS key")
        levels = url_filter.build_cascade(listed, universe)
        told = universe.where(url_filter.in_cascade(levels, universe["key"]))
        assert {r.key for r in told.collect()} == {f"k{i}" for i in range(5)}
        sizes.append(sum(level.bits for level in levels))
    assert sizes[1] < 3 * sizes[0] + 256
    # A level beyond the limit sends the keys to the joins.
    pages = spark.range(20_000).selectExpr("id AS page_id", "concat('http://h', id, '.net/es/x') AS url")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    expected = sorted(map(tuple, url_filter.judge(pages, rules).collect()))
    monkeypatch.setattr(url_filter, "MOST_BITS", 128)
    assert sorted(map(tuple, url_filter.judge(pages, rules).collect())) == expected
