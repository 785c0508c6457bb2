"""Every registered query, and the whole pipeline, run as registered on a small folder, against plain versions."""

from __future__ import annotations

import hashlib
import random
import struct
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from ledgerloom.llm import lz, registry
from ledgerloom.llm.html_text import main_text

sys.path.insert(0, str(Path(__file__).parent))
from test_audit_search_spelling import plain_audit, plain_groups, plain_nearest  # noqa: E402
from test_corpus_operators import plain_components, plain_removal  # noqa: E402

TONGUES = {
    "en": "the of and with house water under these people would about other which their".split(),
    "de": "der und mit nicht haus wasser unter diese leute würde über andere welche ihre".split(),
}


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(21)

    def prose(tongue, n):
        return " ".join(rng.choice(TONGUES[tongue]) + ("" if rng.random() < 0.9 else ",") for _ in range(n))

    docs = []
    shared = prose("en", 40)
    for i in range(90):
        tongue = "en" if i % 2 else "de"
        text = prose(tongue, rng.choice([5, 60, 150]))
        if i % 9 == 0:
            text += "\n" + shared
        docs.append((i, text, tongue if i % 7 else None, f"s{i % 3}" if i % 11 else None, len(text)))
    docs += [(200, docs[5][1], "en", "s1", 0), (201, docs[5][1].upper(), "en", "s1", 0), (202, None, None, None, 0), (203, "", "en", "s0", 0), (204, "½ ² 12", "en", "s0", 0)]
    pages = [(i, f"http://x/{i}", rng.choice([f"<article><h1>t{i}</h1><p>{prose('en', 300)}</article>", "<p>same " + "word " * 300, "", None])) for i in range(30)]
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(120)] + [(500, None, 0), (520, [0.0] * 8, 0)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 90, 2)]
    talks = [(i // 4, i % 4, "user" if i % 2 == 0 else "assistant", rng.choice(["hi </turn>", "\\x <part/>", None, "yes"])) for i in range(40)]
    return {
        "documents": (docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        "pages": (pages, "page_id bigint, url string, html string"),
        "embeddings": (vectors, "vec_id bigint, embedding array<float>, label int"),
        "labels": (labels, "doc_id bigint, quality int, toxic int"),
        "conversations": (talks, "conv_id bigint, turn int, role string, text string"),
    }


@pytest.fixture(scope="module")
def folder(spark, tables, tmp_path_factory):
    place = tmp_path_factory.mktemp("tables")
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{place}/{name}.parquet")
    return str(place)


@pytest.fixture
def texts(tables):
    return [(k, t) for k, t, *_ in tables["documents"][0]]


def result(spark, folder, name):
    return [r.asDict() for r in contract.queries()[name](spark, folder).collect()]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_op1(spark, folder, texts, tables):
    rows = {r["doc_id"]: r for r in result(spark, folder, "op1_langid")}
    assert rows.keys() == {k for k, _ in texts}
    right = []
    for key, text, lang, *_ in tables["documents"][0]:
        r = rows[key]
        assert r["held_out"] == (zlib.crc32(str(key).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if not any(c.isalpha() for c in text or ""):
            assert r["lang_pred"] == "und"
        elif r["held_out"] and lang and key < 200:
            right.append(r["lang_pred"] == lang)
    assert len(right) > 10 and sum(right) > 0.95 * len(right)


def test_op2(spark, folder, tables):
    rows = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in result(spark, folder, "op2_html")}
    expected = {k: main_text(h or "") for k, _, h in tables["pages"][0]}
    assert rows == {k: (f"http://x/{k}", t, len(t)) for k, t in expected.items()} and any(expected.values())


def test_op3(spark, folder, texts):
    rows = {r["doc_id"]: r for r in result(spark, folder, "op3_lz")}
    ordered = sorted((k, t or "") for k, t in texts)
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        cut = len(text) - len(text) // 4
        edited = text[:cut] + following[: len(text) - cut]
        a, b, c = (lz.minima(lz.hashes(lz.parse(t))) for t in (text, edited, following))
        assert rows[key] == {
            "doc_id": key, "n_chars": len(text), "edited_sha256": sha(edited.encode()), "fingerprint": lz.as_text(a),
            "edited_fingerprint": lz.as_text(b), "near_edited": lz.likeness(a, b), "near_next": lz.likeness(a, c),
        }


def test_op5(spark, folder, texts):
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path(registry.VOCABULARY))
    library.no_padding()
    library.no_truncation()
    rows = {r["doc_id"]: r for r in result(spark, folder, "op5_bpe")}
    for key, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[key] == {
            "doc_id": key, "n_tokens": len(ids), "ids_sha256": sha(struct.pack(f"<{len(ids)}I", *ids)), "decoded_sha256": sha(decoded.encode()),
        }


def test_op7(spark, folder, texts):
    expected = {k: (n, gone, spans, sha(kept)) for k, n, gone, spans, kept in plain_removal(texts)}
    rows = {r["doc_id"]: tuple(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in result(spark, folder, "op7_runindex")}
    assert rows == expected and any(gone for _, gone, _, _ in rows.values())


def plain_print(text):
    words = (text or "").encode().lower().split() if (text or "").isascii() else "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op9(spark, folder, texts):
    prints = {k: plain_print(t) for k, t in texts}
    values = sorted(set(prints.values()))
    group = dict(zip(values, plain_components(values, 2), strict=True))
    names = {}
    for k, v in prints.items():
        names[group[v]] = min(k, names.get(group[v], k))
    rows = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in result(spark, folder, "op9_simhash")}
    assert rows == {k: (f"{v:016x}", names[group[v]]) for k, v in prints.items()}
    assert rows[200][1] == rows[201][1] == rows[5][1]


@pytest.mark.parametrize("name", ["op4_warc", "op6_mix", "op8_chat", "op10_quality", "op11_audit", "op12_onebit"])
def test_those_with_sql(spark, folder, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    df = contract.queries()[name](spark, folder)
    columns = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[name]})").fetchall()
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(expected) and expected


def test_op11_and_op12_and_op13(spark, folder, texts, tables):
    audited = Counter(tuple(r.values()) for r in result(spark, folder, "op11_audit"))
    assert audited == plain_audit([(k, t, s) for k, t, _, s, _ in tables["documents"][0]], tables["labels"][0])
    found = sorted(tuple(r.values()) for r in result(spark, folder, "op12_onebit"))
    import numpy as np

    stored = [(i, None if v is None else np.array(v, np.float32).astype(float).tolist()) for i, v, _ in tables["embeddings"][0]]
    assert found == plain_nearest(stored, 20, lambda i: i % 20 == 0)
    words = Counter(tuple(r.values()) for r in result(spark, folder, "op13_spelling"))
    assert words == plain_groups(texts, 199) and words


def test_whole_pipeline(spark, folder, texts):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    left = {r.doc_id for r in rows}
    assert left and not left & {202, 203, 204} and not left & {200, 201}
    assert all(len(r.ids) == 4 * r.n_tokens and r.n_tokens for r in rows)
    # Documents that share nothing with others keep their text and go whole, or cut by the mix to their first words.
    library = Tokenizer.from_file(__import__("public_tokenizers").path(registry.VOCABULARY))
    library.no_truncation()
    kept = {k: b.decode() for k, _, _, _, b in plain_removal([(k, t) for k, t in texts if k < 200])}
    for r in rows:
        words = kept[r.doc_id].split()
        ids = struct.unpack(f"<{r.n_tokens}I", r.ids)
        beginnings = {tuple(library.encode(t, add_special_tokens=False).ids) for t in (kept[r.doc_id], *(" ".join(words[:n]) for n in range(1, len(words) + 1)))}
        assert ids in beginnings


def test_pipeline_of_an_empty_folder(spark, tables, tmp_path):
    spark.createDataFrame([], tables["documents"][1]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
