"""Inputs that are rare but legal: long runs of blanks, numbers beyond a double, half characters, many languages, map columns."""

import json
import random

import pytest
from pyspark.sql import functions as F

from semjoin.llm import chat, exact_dedup, language_id, simhash, token_counts
from semjoin.llm.queries import EOD, QUERIES, TOKENIZER, TOOLS

SMALL = "/root/testdata/sf0.001"
#: Queries that return one row per document.
PER_DOCUMENT = ["op1_exact_dedup", "op2_token_counts", "op3_sharding", "op4_mixing", "op5_simhash_near_dedup", "op6_language_id", "op9_packing", "op10_toxicity",
                "op11_merkle_manifest", "op13_periodic_runs"]


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = QUERIES[name](spark, SMALL)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_long_runs_of_blanks(spark):
    encoding = token_counts._encoding(TOKENIZER)
    for text in ("a" + " " * 1500 + "b c", " " * 1200, "x\n" + " \n" * 700 + "\ty", "q" + "　" * 1100 + "z", " " * 999 + "é"):
        assert token_counts.encode(encoding, text) == encoding.encode_ordinary(text)
    docs = spark.createDataFrame([(1, " " * 1_000_000 + "x"), (2, "x" + "\n " * 400_000), (3, "!" * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, TOKENIZER, EOD).collect()}
    assert set(got) == {1, 2, 3} and min(got.values()) > 0


def test_identifiers_fit_the_files(tmp_path):
    import base64
    wide = tmp_path / "wide"
    wide.write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % (i + 70000 * (i == 65)) for i in range(256)))
    assert token_counts.id_width(str(wide), 300) == 4 and token_counts.id_width(TOKENIZER, EOD) == 2 and token_counts.id_width(TOKENIZER, 70000) == 4
    with pytest.raises(ValueError):
        token_counts.id_width(TOKENIZER, 17)


def test_wide_identifiers_are_counted(spark, tmp_path):
    import base64
    wide = tmp_path / "wide"
    wide.write_bytes(b"\n".join(base64.b64encode(bytes([i])) + b" %d" % (300 + (1 << 16) if i == 65 else i) for i in range(256)))
    docs = spark.createDataFrame([(1, "AAAA"), (2, "bAb"), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, str(wide), 300).collect()}
    assert got == {1: 4, 2: 3, 3: 0}


def test_chat_numbers_and_half_characters(spark):
    def say(arguments):
        return '{"tool_calls": [{"id": "a", "name": "note", "arguments": %s}]}' % arguments
    deep = "[" * 100_000 + "]" * 100_000
    rows = [(1, 0, "assistant", say('{"turn":1e400}')), (1, 1, "tool", '{"tool_call_id": "a", "content": "1e400"}'), (2, 0, "assistant", say('{"text":"x","turn":1}')),
            (2, 1, "tool", json.dumps({"tool_call_id": "a", "content": '"\\ud800"'})), (3, 0, "user", "\\ud800"), (4, 0, "assistant", say(json.dumps(deep))),
            (4, 1, "tool", json.dumps({"tool_call_id": "a", "content": deep}))]
    got = chat.link_and_format(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), TOOLS).collect()
    by = {(r.conv_id, r.kind): r for r in got}
    assert by[1, "call"].status.startswith("invalid_arguments: $") and json.loads(by[1, "result"].json)["content"] == "1e400"
    assert by[2, "call"].status == "ok" and by[2, "result"].json == '{"content":"\\ud800","role":"tool","tool_call_id":"a"}'
    assert by[4, "call"].status.startswith("invalid_arguments") and json.loads(by[4, "result"].json)["content"] == deep


def test_two_hundred_languages(spark):
    rng, docs = random.Random(1), []
    for k in range(200):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(12)]
        docs += [(k * 10 + j, " ".join(rng.choice(words) for _ in range(60)), f"l{k:03d}") for j in range(10)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.train(frame, F.col("doc_id") % 10 < 5)
    assert len(model.languages) == 200
    got = frame.filter("doc_id % 10 >= 5").select("lang", language_id.predict(F.col("text"), model).alias("p")).collect()
    for half in ([r for r in got if r.lang < "l100"], [r for r in got if r.lang >= "l100"]):
        assert sum(r.lang == r.p.lang_pred for r in half) / len(half) > 0.95


def test_only_letters_make_a_language(spark):
    docs = [(i, "the king and the ring", "en") for i in range(20)] + [(100 + i, "der könig und der ring", "de") for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.train(frame, F.lit(True))
    texts = spark.createDataFrame([("10² ½",), ("① Ⅷ ۳",), ("der könig",), ("ª the king",)], "text string").select(language_id.predict(F.col("text"), model).alias("p"))
    assert [r.p.lang_pred for r in texts.collect()] == ["und", "und", "de", "en"]


def test_map_columns(spark):
    docs = spark.sql("SELECT id % 15 AS doc_id, repeat('a b c d ', int(id % 3) + 1) AS text, map('k', id) AS m, map('k', parse_json('{}')) AS hash FROM range(30)")
    kept = exact_dedup.DigestIndex(spark).keep_new(docs, batch=1)
    assert kept.columns == docs.columns and kept.count() == 3
    near = simhash.keep_one_of_each(docs, 3, 2)
    assert near.columns == docs.columns and near.count() == len({r.component_id for r in simhash.near_duplicates(docs).collect()})
