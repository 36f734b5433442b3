"""The pipeline's stages on the smallest tables, each against its own input."""

import re

import corpus_pipeline
import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    from assayer.llm.durable import written

    out = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], DATA)))
    return [[r.asDict() for r in df.collect()] for df in out]


def _shingles(t):
    w = re.findall(r"\w+", (t or "").lower())
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_columns_and_names(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "substring_dedup", "decontamination", "packing"]
    assert all(set(rows[0]) == set(steps[0][0]) for rows in steps[:-1])


def test_every_text_with_letters_passes_language_id(steps):
    assert {r["doc_id"] for r in steps[1]} == {r["doc_id"] for r in steps[0] if any(c.isalpha() for c in r["text"] or "")}


def test_one_document_of_each_group_stays(steps):
    sets = {r["doc_id"]: _shingles(r["text"]) for r in steps[1]}
    root = {i: i for i in sets}
    top = lambda x: x if root[x] == x else top(root[x])
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    assert sorted(r["doc_id"] for r in steps[2]) == sorted(i for i in sets if top(i) == i)


def test_repeats_go_and_clean_texts_stay(steps):
    seen, want = set(), {}
    for r in sorted(steps[2], key=lambda r: r["doc_id"]):
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            if k in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(k)
        want[r["doc_id"]] = " ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else r["text"]
    assert {r["doc_id"]: r["text"] for r in steps[3]} == want


def test_leaking_documents_go(spark, steps):
    items = [_shingles(r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in steps[3] if not any(len(s & _shingles(r["text"])) >= 0.8 * len(s) for s in items)}
    assert {r["doc_id"] for r in steps[4]} == clean


def test_everything_left_is_packed(spark, steps):
    assert sorted(r["doc_id"] for r in steps[5]) == sorted(r["doc_id"] for r in steps[4])
    assert len({(r["batch_id"], r["slot"]) for r in steps[5]}) == len(steps[5])
    assert corpus_pipeline.run(spark, DATA).count() == len(steps[5])


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A small corpus of awkward rows, its folder and what the stages make of it."""
    import random

    from assayer.llm.durable import written

    rng = random.Random(31)
    say = lambda n: " ".join(rng.choice(["the", "cat", "house", "green", "water", "stone", "under", "night", "seven", "paper", "walks"]) + rng.choice(["", "s", "ly"]) for _ in range(n))
    item, base, long = say(30), say(80), say(9000)
    rows = [(k, say(60), "en", "s", None, str(k), 0) for k in range(30)]
    rows += [
        (None, say(50), "en", None, 5, "x", 1), (None, None, None, None, None, None, None), (40, "", "en", "s", 0, "", 2), (41, "12 34 !", None, "s", 7, "", 3), (42, base, "en", "s", None, "first", 4), (43, base + " more", None, "s", None, "near", 5), (42, base, "en", "s", None, "again", 6),
        (44, say(20) + " " + item + " " + say(20), "en", "s", None, "leak", 7), (45, long, "en", "s", None, "long", 8), (46, " ".join(long.split()[100:160]) + " " + say(100), None, "s", None, "repeat", 9), (47, " ".join(long.split()[200:240]), None, "s", None, "all of it repeats", 10),
    ]
    folder = tmp_path_factory.mktemp("odd")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, tx int")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], str(folder))))
    return str(folder), [[r.asDict() for r in df.collect()] for df in out]


def test_odd_rows(odd):
    _, steps = odd
    ids = lambda k: sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in steps[k])
    assert all(set(rows[0]) == set(steps[0][0]) for rows in steps[:-1])
    every = ids(0)
    assert ids(1) == [i for i in every if i not in (40, 41)][1:]  # of the two without an id the one without a text goes
    assert all(r["lang"] == "en" for r in steps[1])
    assert ids(2) == sorted(set(ids(1)) - {43})  # one of the repeated rows, and the smaller id of the near copies
    third = {r["doc_id"]: r for r in steps[3]}
    assert ids(3) == ids(2) and third[47]["text"] == "" and third[47]["n_chars"] == 0 and third[46]["n_chars"] == len(third[46]["text"])
    assert third[45]["text"] == next(r["text"] for r in steps[0] if r["doc_id"] == 45) and third[45]["n_chars"] is None
    assert ids(4) == sorted(set(ids(3)) - {44})
    assert ids(5) == ids(4) and next(r for r in steps[5] if r["doc_id"] == 47)["n_tokens"] == 0
    kept = {(r["doc_id"], r["tx"]): r["lang_pred"] for r in steps[4]}
    assert len(kept) == len(steps[4]) and kept.items() <= {(r["doc_id"], r["tx"]): r["lang_pred"] for r in steps[0]}.items()  # columns whose names clash with ours


def test_empty_table(spark, odd, tmp_path):
    folder, _ = odd
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
