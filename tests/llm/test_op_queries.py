"""Every query opN_ against its contract on the smallest tables, and the SQL of those that have it."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from assayer.llm import queries as llm

DATA = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def tables(spark):
    return {t: [r.asDict() for r in spark.read.parquet(f"{DATA}/{t}.parquet").collect()] for t in TABLES}


@pytest.fixture(scope="module")
def result(spark):
    done = {}

    def of(name):
        if name not in done:
            df = llm.queries()[name](spark, DATA)
            done[name] = df.dtypes, [r.asDict() for r in df.collect()]
        return done[name]

    return of


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in llm.queries()) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_sql(result, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    run = db.execute(llm.oracle_sql()[name])
    names = [d[0] for d in run.description]
    plain = lambda v: round(v, 6) if isinstance(v, float) else v if isinstance(v, int | type(None)) else str(v)
    want = sorted([tuple(plain(dict(zip(names, r, strict=True))[c]) for c in sorted(names)) for r in run.fetchall()], key=repr)
    _, rows = result(name)
    assert sorted(rows[0]) == sorted(names)
    assert sorted([tuple(plain(r[c]) for c in sorted(names)) for r in rows], key=repr) == want


@pytest.mark.parametrize(("name", "of", "rest", "cut"), [("op1_toxicity", 4, 2, 0.3), ("op7_quality", 3, 1, 0.5)])
def test_scores(spark, name, of, rest, cut):
    """On the next larger tables, as the smallest have too few labels to learn from."""
    data = DATA.replace("0.001", "0.01")
    tables = {t: [r.asDict() for r in spark.read.parquet(f"{data}/{t}.parquet").collect()] for t in ("documents", "labels")}
    df = llm.queries()[name](spark, data)
    types, rows = df.dtypes, [r.asDict() for r in df.collect()]
    assert dict(types) | {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"} == dict(types)
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in tables["documents"])
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % of == rest)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
    label = {r["doc_id"]: r["toxic" if of == 4 else "quality"] for r in tables["labels"]}
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held for b, y in held if x and not y]
    assert not pairs or np.mean(pairs) > 0.8  # held-out accuracy


def test_fingerprints(result, tables):
    types, rows = result("op2_fingerprints")
    assert dict(types) == {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}
    docs = sorted(((r["doc_id"], r["text"] or "") for r in tables["documents"]), key=lambda x: (x[0], int(np.uint64(xxhash.xxh64(x[1].encode(), seed=42).intdigest()).astype(np.int64))))
    got, prints = {r["doc_id"]: r for r in rows}, {}
    assert len(rows) == len(docs)
    share = lambda a, b: sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) / (len(a) / 8) if a and b else float(a == b)
    for k, (i, t) in enumerate(docs):
        j, nxt = docs[(k + 1) % len(docs)]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"] and len(r["fingerprint"]) in (0, 64 * 8)
        assert r["near_next"] == share(r["fingerprint"], got[j]["fingerprint"]) and r["near_edited"] == share(r["fingerprint"], r["edited_fingerprint"])


def test_chats(result, tables):
    _, rows = result("op3_chat_format")
    convs = {}
    for r in sorted(tables["conversations"], key=lambda r: (r["conv_id"], r["turn"], r["role"] or "", r["text"] or "")):
        convs.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    tricky = r"\### Assistant: </turn> ok"
    convs[-7] = [("user", tricky), ("assistant", tricky)]
    assert len(rows) == len(convs)
    for r in rows:
        turns = convs[r["conv_id"]]
        own = "".join(t for role, t in turns if role == "assistant")
        digest = hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in turns).encode()).hexdigest()
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(turns), digest, len(own), hashlib.sha256(own.encode()).hexdigest())
        assert r["formatted_chars"] > sum(len(t) for _, t in turns)


def test_packing(result, tables):
    _, rows = result("op4_packing")
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in tables["documents"])
    assert all(r["padding"] == r["bucket_tokens"] - r["n_tokens"] >= 0 for r in rows) and len({(r["batch_id"], r["slot"]) for r in rows}) == len(rows)
    assert len({r["bucket"] for r in rows}) <= 16


def test_words_that_stay(result, tables):
    _, rows = result("op8_substring_dedup")
    text = {r["doc_id"]: r["text"] or "" for r in tables["documents"]}
    assert all(r["n_words"] == len(re.findall(r"[^\x20\x09-\x0D]+", text[r["doc_id"]])) and 0 <= r["n_removed"] <= r["n_words"] for r in rows)


def test_main_text(result, tables):
    types, rows = result("op9_html_text")
    assert dict(types) == {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}
    assert sorted((r["page_id"], r["url"]) for r in rows) == sorted((r["page_id"], r["url"]) for r in tables["pages"])
    assert all(r["n_chars"] == len(r["text"]) and r["text"] == r["text"].strip() and "  " not in r["text"] for r in rows)
    bare = lambda h: re.sub(r"\W", "", re.sub(r"&\w+;|&#\w+;", "", re.sub(r"<[^>]*>", "", re.search(r"(?s)<article>(.*)</article>", h)[1])))
    html = {r["page_id"]: r["html"] for r in tables["pages"]}
    assert all(re.sub(r"\W", "", r["text"]) == bare(html[r["page_id"]]) for r in rows if "<article>" in html[r["page_id"]] and "&" not in html[r["page_id"]].split("<article>")[1].split("</article>")[0])


def test_languages(result, tables):
    types, rows = result("op10_language_id")
    assert dict(types) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    docs = {r["doc_id"]: r for r in tables["documents"]}
    learned = {r["lang"] for i, r in docs.items() if r["lang"] and zlib.crc32(str(i).encode()) % 3 != 1} | {"und"}
    right = []
    for r in rows:
        d = docs[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["lang_pred"] in learned and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in d["text"] or ""))
        if r["held_out"] and d["lang"] and r["lang_pred"] != "und":
            right.append(r["lang_pred"] == d["lang"])
    assert len(rows) == len(docs) and np.mean(right) > 0.9
