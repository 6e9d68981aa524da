"""The whole pipeline over a fixture of our own, the command line, the verdict stream, and the registered queries."""

import json

import duckdb
import pytest

from twinleaf import cli
from twinleaf.functions.text import Literal
from twinleaf.operators import classify, exchange
from twinleaf.plans.pipeline import DONE, NEEDS_SECTION_LABELS, NEEDS_VERDICTS, Pipeline
from twinleaf.streaming.verdicts import keep_latest, latest, verdict_stream

ROWS = [
    ("K-1", "Переводы / По телефону", "Отправка денег по номеру телефона получателю"),
    ("K-2", "Переводы / По телефону", "Отправка денег получателю по номеру телефона"),
    ("K-3", "Переводы / По телефону / Лимиты", "Отправка сверх суточного лимита по телефону"),
    ("K-4", "Переводы / На карту", "Отправка денег на карту другого банка"),
    ("K-5", "Переводы / На карту", "Отправка денег на карту банка другого"),
    ("K-6", "Общее / История", "Просмотр истории операций за месяц"),
    ("K-7", "Общее / История", "Просмотр операций истории за месяц"),
    ("K-8", "Платежи / Газ", "Оплата газа по лицевому договору"),
]
LEMMAS = {"телефона": "телефон", "телефону": "телефон", "карту": "карта", "банка": "банк", "операций": "операция", "истории": "история", "лимиты": "лимит"}


@pytest.fixture
def work(tmp_path):
    (tmp_path / "in.tsv").write_text("id\tsection\tname\n" + "".join("\t".join(r) + "\n" for r in ROWS), encoding="utf-8")
    return tmp_path


def test_pipeline_with_stand_ins(spark, work):
    run = Pipeline(spark, str(work), lemmatizer=Literal(LEMMAS))
    given = str(work / "in.tsv")
    assert run.run(given) == NEEDS_SECTION_LABELS
    labels = classify.rule_labels(run.split()[1]).drop("pos").toPandas().to_dict("records")
    (work / "section_labels.json").write_text(json.dumps({"sections": [{**x, "transfer_types": list(x["transfer_types"])} for x in labels]}), encoding="utf-8")
    assert run.run(given) == NEEDS_VERDICTS
    assert sorted(x.name for x in (work / "batches").iterdir() if not x.name.startswith(".")) == ["batch_0001.json"]
    answers = exchange.rule_verdicts(run.table("candidates"), run.table("features")).collect()
    (work / "verdicts").mkdir()
    (work / "verdicts/batch_0001.jsonl").write_text("".join(json.dumps({"pair_id": r.pair_id, "verdict": r.verdict, "reason": r.reason}) + "\n" for r in answers) + '{"pair_id": "p_K-1__K-2"} oops\n', encoding="utf-8")
    (work / "verdicts/batch_0044.jsonl").write_text(json.dumps({"pair_id": answers[0].pair_id, "verdict": "uncertain"}), encoding="utf-8")  # not in the manifest
    assert run.run(given) == DONE
    assert [r.id for r in run.table("features").collect()] == sorted(r[0] for r in ROWS) and run.meta("features")["count"] == len(ROWS)
    members = sorted(r.member_ids for r in run.table("groups").collect())
    assert members == [["K-1", "K-2"], ["K-4", "K-5"], ["K-6", "K-7"]]
    text = (work / "duplicates_report.md").read_text(encoding="utf-8")
    assert "# Duplicate report" in text and "### Group 1 (2 records" in text and "Платежи / Газ" in text
    before = len(run.ran)
    assert run.run(given) == DONE and len(run.ran) == before  # every stage is stored
    other = Pipeline(spark, str(work), config=run.config.__class__(top_k=1), lemmatizer=Literal(LEMMAS))
    other.run(given)
    assert "candidates" in other.ran  # settings are part of the key
    changed = Pipeline(spark, str(work), lemmatizer=Literal({}))
    changed.classify_auto()
    assert "classified" in changed.ran  # so is the lemmatizer
    run.clean()
    assert not (work / "groups").exists() and (work / "verdicts").exists() and (work / "in.tsv").exists()
    run.clean(deep=True)
    assert not (work / "verdicts").exists()


def test_pipeline_with_a_labeller_and_an_arbiter(spark, work):
    (work / "lemmas.json").write_text(json.dumps(LEMMAS), encoding="utf-8")
    run = Pipeline(spark, str(work), labeller=classify.rule_labels, arbiter=exchange.rule_verdicts)
    assert run.run(str(work / "in.tsv")) == DONE
    assert sorted(r.member_ids for r in run.table("groups").collect()) == [["K-1", "K-2"], ["K-4", "K-5"], ["K-6", "K-7"]]


def test_a_verdict_file_with_bad_lines_opens_the_gate(spark, work):
    run = Pipeline(spark, str(work), lemmatizer=Literal(LEMMAS), labeller=classify.rule_labels)
    assert run.run(str(work / "in.tsv")) == NEEDS_VERDICTS
    (work / "verdicts").mkdir()
    (work / "verdicts/batch_0001.jsonl").write_text("oops\n", encoding="utf-8")
    assert run.run(str(work / "in.tsv")) == DONE
    assert {(r.verdict, r.reason) for r in run.table("verdicts_final").collect()} == {("uncertain", exchange.NO_VERDICT)}


def test_command_line(spark, work, capsys):
    args = ["--input", str(work / "in.tsv"), "--work", str(work)]
    assert cli.main(["run-all", *args], spark) == 0
    assert "NEEDS_SECTION_LABELS" in capsys.readouterr().err
    for command in ("parse", "classify-auto", "classify-merge", "features", "candidates", "batch-pairs", "merge-verdicts", "cluster", "report"):
        assert cli.main([command, *args], spark) == 0
    assert (work / "batches").exists() and (work / "duplicates_report.md").exists()
    assert cli.main(["clean", "--deep", *args], spark) == 0
    with pytest.raises(SystemExit):
        cli.main(["unknown"], spark)
    with pytest.raises(FileNotFoundError):
        cli.main(["parse", *args, "--lemmas", str(work / "none")], spark)


def test_verdict_stream_keeps_the_last(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    (tmp_path / "in/batch_0001.jsonl").write_text('{"pair_id": "p", "verdict": "duplicate"}\noops\n', encoding="utf-8")
    keep_latest(verdict_stream(spark, str(tmp_path / "in")), out, mark).awaitTermination(120)
    (tmp_path / "in/batch_0002.jsonl").write_text('{"pair_id": "p", "verdict": "uncertain"}\n', encoding="utf-8")
    keep_latest(verdict_stream(spark, str(tmp_path / "in")), out, mark).awaitTermination(120)
    assert [(r.pair_id, r.verdict) for r in latest(spark, out).collect()] == [("p", "uncertain")]


def compared(spark, name, query, sql, d="/root/testdata/sf0.001"):
    con = duckdb.connect()
    for t in ("documents", "pages", "part", "orders", "events", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    got, want = query(spark, d), con.sql(sql)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    shown = lambda rows: sorted(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in rows)
    assert shown(map(tuple, got.select(*columns).collect())) == shown(want.project(", ".join(f'"{c}"' for c in columns)).fetchall()), name


CHEAP = ["parse_records", "section_profile", "normalize_documents", "lemma_lookup", "label_extract", "merge_labels", "feature_table", "char_grams", "word_grams", "tfidf_weights", "token_set_ratios", "topk_union_ties", "verdict_parse", "candidates", "duplicate_groups", "tsv_scan", "json_round_trip", "lemma_table", "section_labels", "lexicon_digests", "empty_vocabulary", "group_members", "group_evidence", "lookalike_pairs", "pending_pairs"]


@pytest.mark.parametrize("name", CHEAP)
def test_query_agrees_with_sql(spark, name):
    from twinleaf.plans import queries

    compared(spark, name, queries.queries()[name], queries.oracle_sql()[name])


def test_every_query_has_sql():
    from twinleaf.plans import queries

    assert set(queries.queries()) == set(queries.oracle_sql())


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
