"""Operators on texts against brute force, on small fixtures with nulls, empty and long texts, ties, repeats and odd columns."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from assayer.llm import decontamination, fingerprints, language_id, ngram_join, packing, quality, substring_dedup, toxicity
from assayer.llm import textcore as tc
from assayer.llm.components import components
from assayer.llm.queries import VOCABULARY

SCHEMA = "doc_id long, text string, lang string, key long, n_words string"


def corpus() -> list[tuple]:
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé ".strip()) for _ in range(rng.randint(2, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = prose(120)
    passage = prose(60)
    texts = [base, base, base.replace(" ", "\n", 3), base + " more words here", prose(40) + " " + passage + " " + prose(30), passage + "\t" + prose(25), prose(19), passage, "", None, "   \n\t ", "one", "a b c d", prose(3000) + " " + passage, "x " * 80, base.upper()]
    near = base.split()
    for k in range(12):  # a group of near-copies
        copy = near.copy()
        copy[5 + k] = word()
        texts.append(" ".join(copy))
    rows = [(i, t, "en", i % 3, "clash") for i, t in enumerate(texts)]
    return [*rows, (3, texts[3], "en", 0, "repeat"), (None, prose(50), None, None, None), (-4, passage, "de", 1, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


def test_words_and_hashes():
    texts = ["a bb  ccc", "", None, "déjà vu a\tbb ccc", "Straße"]
    w = tc.words(*tc.utf8(pa.array(texts)), tc.SOLID)
    cut = [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.stop, strict=True)]
    assert cut == ["a", "bb", "ccc", "déjà", "vu", "a", "bb", "ccc", "Straße"]
    assert w.counts.tolist() == [3, 0, 0, 5, 1]
    h = w.hashes()
    assert h[0] == h[5] and h[1] == h[6] and len(set(h.tolist())) == 6
    assert tc.runs(h, 3)[0] == tc.runs(h, 3)[5]
    assert tc.wholes(h, w.first)[1] == tc.wholes(h, w.first)[2]


def test_cover_meets_every_pair_of_places():
    for period, cover in substring_dedup.COVERS.items():
        assert all(any((i + s) % period in cover and (j + s) % period in cover for s in range(period)) for i in range(period) for j in range(period))


@pytest.mark.parametrize("window", [20, 5, 50])
def test_substring_dedup_is_brute_force(spark, docs, window):
    out = substring_dedup.substring_dedup(docs, window=window).collect()
    seen, want = {}, {}
    order = sorted({(r[0] if r[0] is not None else -(1 << 63), r[1]) for r in corpus()}, key=lambda x: (x[0], x[1] or ""))
    for i, t in order:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            if k in seen:
                gone[s : s + window] = [True] * window
            seen.setdefault(k, (i, s))
        want[i, t] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    assert len(out) == len(corpus())
    for r in out:
        key = (r.doc.doc_id if r.doc.doc_id is not None else -(1 << 63), r.doc.text)
        assert (r.n_words, r.n_removed, r.kept) == want[key]
        assert sum(s["last"] - s["first"] for s in r.spans) == r.n_removed
    assert {r.doc.n_words for r in out} == {x[4] for x in corpus()}  # a column that clashes comes back as it was
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0


def _shingles(t):
    w = re.findall(r"\w+", (t or "").lower())
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("block", [1024, 3])
def test_ngram_join_is_brute_force(spark, docs, block):
    rows = corpus()
    sets = [_shingles(r[1]) for r in rows]
    n, links = len(rows), collections.Counter()
    root = list(range(n))
    top = lambda x: x if root[x] == x else top(root[x])
    for i in range(n):
        for j in range(i + 1, n):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[top(j)] = top(i)
    ids = collections.defaultdict(set)
    for i in range(n):
        if rows[i][0] is not None:
            ids[top(i)].add(rows[i][0])
    want = sorted((rows[i][0] if rows[i][0] is not None else -(1 << 63), min(ids[top(i)], default=None), links[i]) for i in range(n))
    out = ngram_join.ngram_join(docs, block=block).collect()
    assert sorted((r.rid, r.class_id, r.n_links) for r in out) == want
    assert len({(r.keep_rid, r.keep_tx) for r in out if r.rid == r.keep_rid}) >= 1
    assert ngram_join.ngram_join(docs.limit(0)).count() == 0


def test_bayesian_bound_is_monotone():
    bounds = [ngram_join.least_matches(0.8, 1e-6, n) for n in (16, 32, 64, 128)]
    assert bounds == sorted(bounds) and bounds[-1] < 0.8 * 128


def test_ties_are_told_apart_by_64_bits(spark):
    """Texts of one id whose 32-bit hashes are equal keep their own words."""
    seen, n = {}, 0
    import struct

    def murmur(raw):  # the 32-bit hash with seed 42 of text whose length is a multiple of four
        h = 42
        for (k,) in struct.iter_unpack("<I", raw):
            k = k * 0xCC9E2D51 & 0xFFFFFFFF
            k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
            h = ((h ^ k) << 13 | (h ^ k) >> 19) & 0xFFFFFFFF
            h = h * 5 + 0xE6546B64 & 0xFFFFFFFF
        h ^= len(raw)
        for s, m in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            h = (h ^ h >> s) * m & 0xFFFFFFFF
        return h

    pairs = []
    while len(pairs) < 3:
        t = f"w{n:07d}"
        if (h := murmur(t.encode())) in seen:
            pairs.append((seen[h], t))
        seen[h], n = t, n + 1
    run = " ".join(f"x{k}" for k in range(25))
    for a, b in pairs:
        # The hash of a text that begins alike goes on alike; only one of them repeats the run.
        tail = " " + run + " " * (-(len(run) + 1) % 4)
        texts = [(None, a + tail), (None, b + " y" * ((len(tail)) // 2)), (None, run)]
        out = {r.doc.text: r.n_removed for r in substring_dedup.substring_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
        assert sorted([out[texts[0][1]], out[run]]) == [0, 25] and len(out) == 3


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(k, k + 1) for k in range(1000, 1040)]
    root = {x: x for e in edges for x in e}
    top = lambda x: x if root[x] == x else top(root[x])
    for a, b in edges:
        lo, hi = sorted((top(a), top(b)))
        root[hi] = lo
    want = {x: top(x) for e in edges if e[0] != e[1] for x in e}
    assert {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()} == want


@pytest.mark.parametrize("item_block", [20_000, 2])
def test_leaks_are_brute_force(spark, docs, item_block):
    rows = corpus()
    passage, long = rows[7][1].split(), rows[13][1].split()
    items = [(1, rows[7][1]), (2, " ".join(passage[:8])), (3, " ".join(long[500:517])), (4, " ".join([*passage[:50], "changed", *passage[51:]])), (5, "not in any text of these"), (6, ""), (7, None), (8, "a b c d"), (8, "a b c d"), (None, " ".join(long[100:200]))]
    found = decontamination.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), item_block=item_block)
    for r in found.collect():
        w = re.findall(r"\w+", (r.doc.text or "").lower())
        want = []
        for i, t in items:
            own = re.findall(r"\w+", (t or "").lower())
            n = min(5, len(own))
            if n:
                have = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
                need = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)}
                if len(have & need) >= 0.8 * len(need):
                    want.append((i, round(len(have & need) / len(need), 9)))
        assert sorted(((x.item_id, round(x.share, 9)) for x in r.leaks), key=str) == sorted(want, key=str)
    assert found.count() == len(rows)
    nothing = decontamination.find_leaks(docs, spark.createDataFrame([], "item_id long, text string"))
    assert nothing.where(F.size("leaks") > 0).count() == 0
    assert decontamination.find_leaks(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_items_of_few_shingles_are_never_missed():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    cycle = lambda words, kinds: " ".join((list(word() for _ in range(kinds)) * words)[:words])
    texts = [" ".join(word() for _ in range(k)) for k in range(1, 10) for _ in range(20)]
    texts += [cycle(words, kinds) for words, kinds in ((60, 1), (60, 2), (60, 4), (200, 4), (200, 10), (200, 20)) for _ in range(10)]
    items = decontamination.Items(np.arange(len(texts)), pa.array(texts), 5, 64, 0.8)
    docs = ["", *(" ".join([*(word() for _ in range(rng.randint(0, 300))), t, *(word() for _ in range(300))]) for t in texts), None]
    doc, item, share = items.search(pa.array(docs))
    found = {(d, i): s for d, i, s in zip(doc.tolist(), item.tolist(), share.tolist(), strict=True)}
    assert all(found.get((i + 1, i)) == 1.0 for i in range(len(texts))) and len(found) == len(doc)


def _bits(trees: list[bytes], text: bytes) -> float:
    """Code length by the definition, order 3 down to 0, method C."""
    counts = collections.defaultdict(collections.Counter)
    for t in trees:
        padded = b"\n\n\n" + t
        for i in range(3, len(padded)):
            for k in range(4):
                counts[padded[i - k : i]][padded[i]] += 1
    total, padded = 0.0, b"\n\n\n" + text
    for i in range(3, len(padded)):
        for k in (3, 2, 1, 0):
            c = counts.get(padded[i - k : i])
            if not c:
                continue
            n, q = sum(c.values()), len(c)
            if padded[i] in c:
                total -= np.log2(c[padded[i]] / (n + q))
                break
            total -= np.log2(q / (n + q))
        else:
            total += 8
    return total


def test_code_lengths_are_exact():
    texts = {"aa": ["abracadabra", "été"], "bb": ["xyzzy", "", "zyx ab"]}
    model = language_id.Model({k: pa.array(v) for k, v in texts.items()})
    probe = pa.array(["abra", "", "zéro", "xyz" * 5])
    got = model.code_lengths(*tc.utf8(probe))
    for i, p in enumerate(probe.to_pylist()):
        for j, lang in enumerate(model.langs):
            assert got[i, j] == pytest.approx(_bits([t.encode() for t in texts[lang]], p.encode()), rel=1e-5, abs=1e-6)


def test_language_id(spark):
    rng = random.Random(1)
    say = {"en": "the cat and dog went to town with their bag".split(), "de": "der hund und die katze ging mit ihrem sack zur stadt".split()}
    rows = [(i, " ".join(rng.choice(say[x]) for _ in range(20)), x, "") for i in range(60) for x in ["en" if i % 2 else "de"]]
    odd = [(900, None, "en", ""), (901, "", "de", ""), (902, "123 ... !", None, ""), (903, "é", None, ""), (None, "the dog", None, "")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, lang_pred string")
    out = {r.doc.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, language_id.train(df.where("doc_id < 40"))).collect()}
    assert all(out[i][0] == x for i, _, x, _ in rows)
    assert [out[i][0] for i in (900, 901, 902)] == ["und"] * 3 and out[903][0] in ("de", "en") and out[None][0] == "en"
    assert all(0 <= s <= 1 for _, s in out.values())
    untrained = language_id.identify(df, language_id.train(df.limit(0)))
    assert {r.lang_pred for r in untrained.collect()} == {"und"}


@pytest.mark.parametrize("broadcast_langs", [10_000, 5])
def test_all_languages_are_learned(spark, broadcast_langs):
    rows = [(i, f"{'xyz'[i % 3] * 4} {i}", f"l{i // 2}") for i in range(600)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), broadcast_langs=broadcast_langs)
    assert set(model.langs) == {f"l{k}" for k in range(300)}


def test_factorisation_machine_identity():
    fm = quality.FactorisationMachine([np.array([1.0])], 8, 3)
    fm.w = np.arange(len(fm.w)) / 10
    number, x, first = np.array([0, 3, 8, 1]), np.array([1.0, 0.5, 2.0, 1.0]), np.array([0, 3, 4])
    raw, _ = fm.raw(number, x, first)
    by_pairs = sum(fm.w[i] * v for i, v in zip(number[:3], x[:3], strict=True)) + sum(fm.v[number[a]] @ fm.v[number[b]] * x[a] * x[b] for a in range(3) for b in range(a + 1, 3))
    assert raw[0] == pytest.approx(by_pairs) and raw[1] == pytest.approx(fm.w[1])


def test_quality(spark):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["plain", "words", "in", "a", "row", "again"]) for _ in range(30)) + "."
    bad = lambda: " ".join(rng.choice(["BUY", "NOW", "!!!", "$$$", "CHEAP"]) for _ in range(30))
    texts = [good() if i % 2 else bad() for i in range(200)]
    model = quality.train(pa.table({"text": texts[:120], "label": [i % 2 for i in range(120)]}))
    df = spark.createDataFrame([*[(i, t, "s") for i, t in enumerate(texts)], (None, None, None), (1000, "", "")], "doc_id long, text string, score string")
    out = {r.doc.doc_id: r.score for r in quality.score(df, model).collect()}
    assert all((out[i] >= 0.5) == (i % 2 == 1) for i in range(120, 200))
    assert all(0 <= s <= 1 for s in out.values()) and len(out) == 202
    assert quality.train(pa.table({"text": pa.array([], pa.string()), "label": pa.array([], pa.int32())})).scores(pa.array(["x"]))[0] == 0.5


def test_quality_scores_are_the_definition(spark):
    """Scores of a fitted model against the sum over all pairs of features, text by text."""
    rng = random.Random(33)
    texts = [" ".join(rng.choice(["Plain", "words", "in", "a", "row", "!!!", "$$"]) for _ in range(rng.randint(0, 25))) for _ in range(80)]
    model = quality.train(pa.table({"text": texts, "label": [int("!!!" not in t) for t in texts]}), buckets=64, rank=3, bins=4)
    number, x, first = model.features(pa.array(texts))
    for d, t in enumerate(texts):
        i, v = number[first[d] : first[d + 1]], x[first[d] : first[d + 1]]
        # Words: each bucket once, scaled to length 1; then one bin of each statistic.
        buckets = sorted({int(h % np.uint64(64)) for h in tc.words(*tc.utf8(pa.array([t])), tc.SOLID).hashes()})
        assert sorted(i[i < 64].tolist()) == buckets and (not buckets or np.isclose((v[i < 64] ** 2).sum(), 1))
        assert (i >= 64).sum() == len(model.edges) and (v[i >= 64] == 1).all()
        raw = model.w0 + sum(model.w[a] * p for a, p in zip(i, v, strict=True)) + sum(model.v[i[a]] @ model.v[i[b]] * v[a] * v[b] for a in range(len(i)) for b in range(a + 1, len(i)))
        assert model.scores(pa.array([t]))[0] == pytest.approx(1 / (1 + np.exp(-raw)))
    rows = [(1, "plain words " * 100_000, "s"), (2, texts[0], None), (2, texts[0], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = quality.score(df, model).collect()
    assert len(out) == 3 and len({r.score for r in out if r.doc.doc_id == 2}) == 1 and quality.score(df.limit(0), model).count() == 0


def test_samples_are_bounded_whatever_repeats(spark):
    from assayer.llm.samples import bounded_rows, labelled_sample

    docs = spark.createDataFrame([(i % 3 if i < 600 else i, f"text {i % 5 if i < 600 else i}") for i in range(1000)] + [(None, "no id")] * 50, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in [0, 1, 2, *range(600, 1000)]] * 2 + [(None, 1)], "doc_id long, toxic int")
    sample = labelled_sample(docs, labels, "toxic", 100)
    assert 120 < sample.num_rows < 280 and len(set(sample.column("text").to_pylist())) >= sample.num_rows - 2
    assert labelled_sample(docs, labels.limit(0), "toxic", 100).num_rows == 0
    few = bounded_rows(docs, ["doc_id", "text"], 30).collect()
    assert 0 < len(few) <= 30 and len(set(few)) == len(few)
    same = spark.createDataFrame([(None, "abc", "xx")] * 5000 + [(k, f"abc {k}", "yy") for k in range(50)], "doc_id long, text string, lang string")
    assert set(language_id.train(same).langs) == {"xx", "yy"}
    assert {r.lang_pred for r in language_id.identify(spark.createDataFrame([(1, "abc " * 200_000)], "doc_id long, text string"), language_id.train(same)).collect()} <= {"xx", "yy"}
    assert language_id.identify(same.limit(0), language_id.train(same)).count() == 0


def test_toxicity_grammar():
    model = toxicity.ToxicityModel(toxicity.Lexicon({"idiot", "moron"}, {"vequ"}))
    events = lambda t: [e for _, _, out, _ in model.clauses(t) for e in out]
    assert events("What an idiot.") == ["insult"]
    assert events("you are a moron, he sat") == ["targeted"]
    assert events("he is not an idiot") == ["negated"]
    assert events("she said that he is a moron") == ["reported"]
    assert events("I will kill you") == ["threat"] and events("kill the process") == []
    assert events("vequaire là. Rien") == ["insult"] and events("not bad. idiot") == ["insult"]
    assert events("idiot you") == events("you idiot") == events("idiot that they are you") == ["targeted"]
    assert events("idiot one two three four you") == ["insult"] and events("idiot moron you") == ["insult", "targeted"]
    assert events("do not kill the process") == events("someone said kill switch") == [] and events("he will not kill you") == ["negated"]
    scores = model.scores(pa.array(["", None, "nothing here", "you idiot", "idiot", "not an idiot", "kill the process", "do not kill the process", "never kill time", "someone said kill switch"]))
    assert scores[0] == scores[1] == scores[2] == scores[6] == scores[7] == scores[8] == scores[9] < scores[5] < scores[4] < scores[3]
    assert model.grammar.run(["TARGET", "INSULT", "END"])[1] == toxicity.PRIOR["targeted"]


def _interpreted(labels):
    """The events of a clause by the five machines' definitions, hit by hit."""
    hits = [i for i, x in enumerate(labels) if x in ("INSULT", "THREAT")]
    out = []
    for i in hits:
        reported = "SPEECH" in labels[:i]
        negated = not reported and "NEGATION" in labels[max(0, i - 3) : i]
        aimed = "TARGET" in labels[max(0, i - 4) : i]
        after = labels[i + 1 : i + 5]
        if "TARGET" in after and not aimed:
            aimed = not any(x in ("INSULT", "THREAT") for x in after[: after.index("TARGET")])
        if labels[i] == "THREAT" and not aimed:
            continue
        out.append("reported" if reported else "negated" if negated else "threat" if labels[i] == "THREAT" else "targeted" if aimed else "insult")
    return out


def test_composed_grammar_is_the_interpreter():
    rng, machine = random.Random(12), toxicity.grammar()
    names = [x for x in toxicity.LABELS if x != "END"]
    for _ in range(4000):
        labels = rng.choices(names, [3, 3, 2, 2, 1, 5], k=rng.randint(0, 12))
        out, weight = machine.run([*labels, "END"])
        want = _interpreted(labels)
        assert sorted(e for e in out if e) == sorted(want), labels
        assert weight == pytest.approx(sum(toxicity.PRIOR[e] for e in want))


def test_negation_and_report_never_raise_a_score():
    rng = random.Random(13)
    model = toxicity.ToxicityModel(toxicity.Lexicon({"idiot", "moron"}, set()))
    words = ["idiot", "moron", "kill", "you", "tree", "went", "is"]
    for fitted in (False, True):
        if fitted:  # even when the sample says that negated insults are the toxic ones
            texts = ["he is not an idiot"] * 40 + ["what an idiot", "you moron"] * 20
            model.fit(pa.array(texts), np.array([1] * 40 + [0] * 40))
        for _ in range(300):
            clauses = [[rng.choice(words) for _ in range(rng.randint(1, 7))] for _ in range(rng.randint(1, 4))]
            k = rng.randrange(len(clauses))
            base = ". ".join(" ".join(c) for c in clauses)
            at = rng.randrange(len(clauses[k]) + 1)
            for added in ("not", "said"):
                # In the place of a word without a part, so distances stay.
                other = [list(c) for c in clauses]
                if at < len(other[k]) and other[k][at] in ("tree", "went", "is"):
                    other[k][at] = added
                    plain, changed = model.scores(pa.array([base, ". ".join(" ".join(c) for c in other)]))
                    assert changed <= plain + 1e-12


def test_toxicity_edge_cases(spark):
    model = toxicity.ToxicityModel(toxicity.Lexicon({"idiot"}, set()))
    long = "tree " * 200_000 + "you idiot"
    rows = [(1, long, 0.5), (2, "you idiot", None), (2, "you idiot", None), (None, None, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    out = [(r.doc.doc_id, r.doc.score, r.score) for r in toxicity.score(df, model).collect()]
    assert len(out) == 4 and len({s for i, _, s in out if i in (1, 2)}) == 1 and {c for _, c, _ in out} == {0.5, None, 1.0}
    assert toxicity.score(df.limit(0), model).count() == 0
    assert toxicity.train(pa.table({"text": pa.array([], pa.string()), "label": pa.array([], pa.int32())})).scores(pa.array(["you idiot"]))[0] > 0.3


def test_speech_goes_on_after_commas_and_colons():
    model = toxicity.ToxicityModel(toxicity.Lexicon({"idiot", "moron"}, set()))
    events = lambda t: [e for _, _, out, _ in model.clauses(t) for e in out]
    assert events("he said, you are an idiot") == events("she wrote: you moron") == events("he said, well, \u201cyou idiot\u201d") == ["reported"]
    assert events("he said. you are an idiot") == events("he said hello; you idiot") == events("well, you idiot") == ["targeted"]


def test_toxicity_evidence_is_the_grammar_whatever_marks_touch_a_word():
    model = toxicity.ToxicityModel(toxicity.Lexicon({"idiot", "connard", "ηλιθιος"}, {"vequ"}))
    marks = ["", "\u201c", "\u201d", "\u2019", "\u00a0", "\u2014", "\u2026", "\u00ab", "\u00bf", "\u3000", "\u0301", "\u0130", "é", "_", "."]
    texts = [f"so {a}{w}{b} you" for a in marks for b in marks for w in ("idiot", "Connard", "vequaire", "kill", "ΗΛΙΘΙΟΣ", "tree")]
    found = [any(True for _ in model.clauses(t)) for t in texts]  # each of these has an aim
    assert model.evidence(pa.array(texts)).any(axis=1).tolist() == found
    assert sum(found) > len(texts) / 2


def test_toxicity_learns_words_and_stems(spark):
    rng = random.Random(4)
    plain = lambda: " ".join(rng.choice(["maison", "arbre", "ville", "route", "soleil"]) + rng.choice("abc") for _ in range(40))
    ends = ["ta", "ais", "oir", "eur", "mo", "ille"]
    texts, labels = [], []
    for i in range(160):
        toxic = i % 4 == 0
        texts.append(plain() + (" zoquet" + rng.choice(ends) if toxic else "") + " " + plain())
        labels.append(int(toxic))
    model = toxicity.train(pa.table({"text": texts, "label": labels}))
    assert any("zoquet".startswith(s) or s.startswith("zoquet") for s in model.lexicon.stems)
    scores = model.scores(pa.array([plain(), plain() + " zoquetoir"]))
    assert scores[0] < 0.3 <= scores[1]
    df = spark.createDataFrame([(1, None), (2, "zoquetta")], "doc_id long, text string")
    assert {r.doc.doc_id: r.score >= 0.3 for r in toxicity.score(df, model).collect()} == {1: False, 2: True}


def _weights(t):
    out = collections.Counter()
    for w, n in collections.Counter((t or "").split()).items():
        out[w] = n * len(w)
    return out


def test_fingerprints(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    texts = [" ".join(word() for _ in range(60)) for _ in range(24)] + ["", None, "é", "same", "same"]
    rows = [(5 * i, t, "x") for i, t in enumerate(texts)] + [(None, "first of all", "x"), (20, "tie on an id", "y"), (1 << 62, "far away", "z"), (-(1 << 62), "x" * 70_000 + " and more", "z")]
    rows += [(60, "told again and again", str(i)) for i in range(9)] + [(None, None, "x")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, b string").repartition(3)
    for per_range in (256, 4):
        out = fingerprints.edited_fingerprints(df, samples=24, per_range=per_range).collect()
        # Ties on an id follow a hash of the text; an id that is null comes first.
        order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], np.int64(np.uint64(xxhash.xxh64((r[1] or "").encode(), seed=42).intdigest()).astype(np.int64))))
        want, errors = [], []
        for k, (i, t, _) in enumerate(order):
            t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
            edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
            want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, nxt, t))
        assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in out) == sorted((str(w[0]), *w[1:3]) for w in want)
        # Rows that repeat an id and its text differ in the next document alone.
        likeness = lambda a, b: sum((_weights(a) & _weights(b)).values()) / max(1, sum((_weights(a) | _weights(b)).values())) if a.split() or b.split() else 1.0
        got, true = collections.defaultdict(list), collections.defaultdict(list)
        for r in out:
            got[r.doc_id, r.n_chars, r.edited_sha256].append((r.near_next, r.near_edited))
        for i, n, sha, edited, nxt, t in want:
            true[i, n, sha].append((likeness(t, nxt), likeness(t, edited)))
        for key, pairs in true.items():
            for x, y in zip(sorted(got[key]), sorted(pairs), strict=True):
                errors += [x[0] - y[0], x[1] - y[1]]
        assert abs(np.mean(errors)) < 0.04 and np.std(errors) < 0.12
        prints = {r.doc_id: r.fingerprint for r in out}
        assert prints[27 * 5] == prints[28 * 5] and prints[24 * 5] == ""
    assert fingerprints.edited_fingerprints(df.limit(0), samples=4).count() == 0


def test_fingerprints_weigh_long_words_in_full(spark):
    shared = " ".join(f"word{k:03}" for k in range(188))
    df = spark.createDataFrame([(1, shared + " " + "x" * 10_000), (2, shared + " " + "y" * 10_000)], "k int, text string")
    a, b = (r.sig for r in fingerprints.fingerprint(df, "k", "text", samples=24).collect())
    # The generalised Jaccard similarity is 1316 / 21316; with weights of at most 255 it would be 0.72.
    assert sum(x == y for x, y in zip(a, b, strict=True)) / 24 < 0.35


def test_fingerprints_have_all_samples(spark):
    df = spark.createDataFrame([(1, "some words and some more"), (2, None)], "k int, text string")
    one, many = ({r.k: r.sig for r in fingerprints.fingerprint(df, "k", "text", *n).collect()} for n in ((10,), ()))
    assert len(many[1]) == 64 and many[1][:10] == one[1] and many[2] is one[2] is None


def test_gamma_quantiles():
    x = fingerprints._gamma2_quantile(0.5)
    assert 1 - (1 + x) * np.exp(-x) == pytest.approx(0.5)


def test_boundaries_are_optimal():
    rng = random.Random(8)
    lengths = [rng.randint(0, 30) for _ in range(80)]
    import itertools

    padding = lambda cut, of: sum(min(b for b in cut if b >= x) - x for x in of)
    for of in (lengths, [x * 977 + rng.randint(0, 400) for x in lengths[:25]], [rng.choice([0, 5, 2000, 2001, 90_000]) for _ in range(40)]):
        cells = sorted(collections.Counter(of).items())
        tops = [c[0] for c in cells]
        for buckets in (1, 2, 3, 4):
            if len(tops) >= buckets:
                best = min(padding([*c, tops[-1]], of) for c in itertools.combinations(tops[:-1], buckets - 1))
                cut = packing.boundaries(cells, buckets)
                assert padding(cut, of) == best and len(cut) <= buckets
    assert packing.boundaries([], 4) == [] and packing.boundaries([(7, 2)], 4) == [7] and packing.boundaries([(1, 1), (2, 1), (3, 1)], 9) == [1, 2, 3]
    wide = packing.boundaries([(k, 1 + k % 7) for k in range(60_000)], 16)
    assert len(wide) == 16 and wide[-1] == 59_999


def test_rows_repeated_very_often_are_dealt_into_shards(spark):
    df = spark.createDataFrame([(None, "the same text")] * 3000 + [(k, f"text {k}") for k in range(200)], "doc_id long, text string").repartition(2)
    lengths = packing.token_counts(df, VOCABULARY)
    assert max(r["count"] for r in lengths.groupBy("rid", "tx", "again").count().collect()) <= 2 * packing.REPEATS
    out = packing.pack(df, VOCABULARY, budget=40, buckets=2, shard=100).collect()
    assert len(out) == 3200 and len({(r.batch_id, r.slot) for r in out}) == 3200
    sizes = collections.Counter((r.bucket, r.batch_id, max(1, 40 // r.bucket_tokens)) for r in out)
    assert all(sum(n < full for (b, _, full), n in sizes.items() if b == bucket) <= 1 for bucket in {r.bucket for r in out})


def test_packing(spark, docs):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    encode = tiktoken.Encoding("own", pat_str=packing.SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    out = packing.pack(docs, VOCABULARY, budget=600, buckets=4, shard=5).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == sorted((x[0] or 0, len(encode(x[1] or ""))) for x in corpus())
    sizes = collections.Counter((r.bucket, r.batch_id) for r in out)
    for b in {r.bucket for r in out}:
        top = next(r.bucket_tokens for r in out if r.bucket == b)
        full = max(1, 600 // max(1, top))
        assert all(0 <= r.padding == r.bucket_tokens - r.n_tokens for r in out if r.bucket == b)
        own = sorted(n for (k, _), n in sizes.items() if k == b)
        assert own[1:] == [full] * (len(own) - 1) and own[0] <= full
    assert len({(r.batch_id, r.slot) for r in out}) == len(out)
    assert packing.pack(docs.limit(0), VOCABULARY).count() == 0
    assert sum(len(r.doc_ids) for r in packing.batches(packing.pack(docs, VOCABULARY, budget=600)).collect()) == len(corpus())  # null ids too
