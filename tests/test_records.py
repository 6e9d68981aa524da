"""Sources, classification, pairs, exchange and groups on small tables."""

import json
import re

import pytest
from pyspark.sql import functions as F

from twinleaf.config import Config
from twinleaf.functions.lexicon import RUSSIAN
from twinleaf.operators import classify, components, exchange, features, groups, pairs, similarity
from twinleaf.sources import exchange as files
from twinleaf.sources import records

FEATURES = "id string, name string, section string, section_category string, name_lemmas array<string>, name_lemma_text string, stripped_name string, transfer_type_set array<string>, feature_block_key string"


def feature_rows(spark, names, types=("card",), key=""):
    return spark.createDataFrame([(f"T-{i:03}", n, "s", "other", n.split(), n, n, list(types), key) for i, n in enumerate(names)], FEATURES)


def test_tsv(spark, tmp_path):
    p = tmp_path / "in.tsv"
    p.write_text('id\tsection\tname\textra\n1\tA / B\t"say ""hi"""\tx\n\n 2 \t\tплан\n3\tA\n\tA\tno id\n', encoding="utf-8")
    got = [tuple(r) for r in records.read_records(spark, str(p)).orderBy("pos").select("id", "section", "name").collect()]
    assert got == [("1", "A / B", 'say "hi"'), ("2", "", "план")]


def test_tsv_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="section"):
        records.read_tsv(spark, str(tmp_path / "none.tsv"))
    p = tmp_path / "bom.tsv"
    p.write_text("\ufeffid\tsection\tname\n1\ta\tb\n", encoding="utf-8")
    with pytest.raises(ValueError, match="id"):
        records.read_tsv(spark, str(p))
    p.write_text("id\tname\n1\tb\n", encoding="utf-8")
    with pytest.raises(ValueError, match="section"):
        records.read_tsv(spark, str(p))
    p.write_text("id\tsection\tname\n1\ta\tb\n1\ta\tc\n", encoding="utf-8")
    with pytest.raises(ValueError, match="duplicate id"):
        records.read_records(spark, str(p))


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", None), ("2", "я")], "id string, name string")
    for end in ("t.parquet", "t.jsonl"):
        records.write_table(df, str(tmp_path / end))
        assert sorted(tuple(r) for r in records.read_table(spark, str(tmp_path / end)).select("id", "name").collect()) == [("1", None), ("2", "я")]


def test_profile_takes_the_first_names(spark):
    df = spark.createDataFrame([(str(i), "A / B" if i < 7 else "C", f"n{i}", i) for i in range(8)], "id string, section string, name string, pos long")
    got = {r.section: (r["segments"], r["count"], r.sample_names) for r in classify.section_profile(classify.parse_records(df)).collect()}
    assert got == {"A / B": (["A", "B"], 7, ["n0", "n1", "n2", "n3", "n4"]), "C": (["C"], 1, ["n7"])}


def test_categories_and_routes(spark):
    given = ["Переводы / Карта", "Лимиты", "Карта / Лимиты", "Прочее"]
    df = classify.classify_sections(spark.createDataFrame([(s,) for s in given], "section string"), RUSSIAN)
    got = {r.section_path: (r.category, r.confidence) for r in df.collect()}
    assert got == {given[0]: ("transfer-type", 0.9), given[1]: ("feature", 0.9), given[2]: ("mixed", 0.55), given[3]: ("unknown", 0.0)}
    sure, unsure = classify.route(df)
    assert {r.section_path for r in unsure.collect()} == set(given[2:]) and sure.count() == 2


def test_labels_merge_with_precedence(spark):
    schema = "section_path string, category string, transfer_types array<string>, feature_score int, confidence double"
    sure = spark.createDataFrame([("a", "feature", [], 1, 0.9)], schema)
    unsure = spark.createDataFrame([("b", "mixed", ["card"], 1, 0.55), ("c", "unknown", [], 0, 0.0), ("d", "mixed", ["qr"], 1, 0.55)], schema)
    text = json.dumps({"sections": [{"section_path": "a", "category": "mixed"}, {"section_path": "b", "category": "feature"}, {"section_path": "b", "category": "transfer-type", "transfer_types": [" Card", "card", ""], "reason": "r"}, {"section_path": "c", "category": "wrong"}]})
    labels = files.parse_section_labels(spark.createDataFrame([(text,)], "value string"))
    got = {r.section_path: (r.category, r.transfer_types, r.source, r.reason) for r in classify.merge_labels(sure, unsure, labels).collect()}
    assert got == {"a": ("feature", [], "heuristic", None), "b": ("transfer-type", ["card"], "llm", "r"), "c": ("other", [], "fallback", None), "d": ("mixed", ["qr"], "fallback", None)}


def test_label_file_shapes(spark, tmp_path):
    assert files.read_section_labels(spark, str(tmp_path / "none.json")).count() == 0
    one = {"section_path": "x", "category": "other", "transfer_types": None}
    for text, n in ((json.dumps([one]), 1), (json.dumps({"sections": [one]}), 1), ("3", 0), ('{"other": 1}', 0)):
        assert files.parse_section_labels(spark.createDataFrame([(text,)], "value string")).count() == n
    with pytest.raises(Exception, match="malformed"):
        files.parse_section_labels(spark.createDataFrame([("{oops",)], "value string")).collect()


def test_block_keys(spark):
    df = spark.createDataFrame([(["b", "a"], "k"), ([], "k"), ([], None)], "t array<string>, k string")
    assert [r[0] for r in df.select(features.block_key(F.col("t"), F.col("k"))).collect()] == [["a", "b"], ["__feature__", "k"], ["__feature__", ""]]


def test_identical_and_unrelated_titles(spark):
    got = pairs.candidates(feature_rows(spark, ["перевод карта лимит", "перевод карта лимит", "zzz"])).collect()
    assert len(got) == 1 and got[0].score >= 0.99 and got[0].tier == "high_confidence" and got[0].pair_id == "p_T-000__T-001"
    assert pairs.candidates(feature_rows(spark, ["совсем одно", "xyz"])).count() == 0
    assert pairs.candidates(feature_rows(spark, [])).count() == 0


def test_blocks_are_not_crossed(spark):
    both = feature_rows(spark, ["один два"]).union(feature_rows(spark, ["-", "один два"], ("qr",)))
    assert pairs.candidates(both).count() == 0


def test_top_k_bounds_the_pairs(spark):
    names = [f"перевод на карту вариант {i}" for i in range(7)]
    n = pairs.candidates(feature_rows(spark, names), Config(lower=0.4, upper=0.9, top_k=2)).count()
    assert 0 < n <= 14 and n < 21


def test_top_k_ties_go_to_the_lower_partner(spark):
    df = spark.createDataFrame([("a", "b", 0.9), ("a", "c", 0.9), ("a", "d", 0.9), ("b", "c", 0.1), ("c", "d", 0.95)], "a_id string, b_id string, score double")
    assert {(r.a_id, r.b_id) for r in pairs.top_pairs(df, 1).collect()} == {("a", "b"), ("c", "d")}


def test_copies_form_no_pairs_among_themselves(spark, monkeypatch):
    names = ["перевод на карту"] * 90 + ["перевод на карты"] * 3 + ["перевод на карту два", "!!", "!!", ""]
    rows, seen, scored = feature_rows(spark, names), [], pairs.scored
    items = pairs.items_of(rows)
    want = {(r.a_id, r.b_id): r.score for r in pairs.top_pairs(scored(pairs.cosines(items), items), 5).collect()}
    monkeypatch.setattr(pairs, "scored", lambda p, *a: seen.append(p.count()) or scored(p, *a))
    got = {(r.a_id, r.b_id): r.score for r in pairs.candidates(rows).collect()}
    assert got.keys() == want.keys() and got == pytest.approx(want, abs=1e-4)
    assert seen[0] <= 6  # of 4005 among the copies alone


def test_features_read_the_pages_once(spark):
    from twinleaf.plans import queries

    found = queries.feature_rows(spark, "/root/testdata/sf0.001")
    assert not [f for f in found.inputFiles() if "pages.parquet" in f] and found.count()


def test_top_k_of_parts_forms_no_pairs_of_copies(spark, tmp_path):
    from twinleaf.plans import queries

    names = ["red bolt", "red bolt", "blue bolt", "!", "!", "red ring"]
    rows = [(i, names[i % 6] if i < 300 else "green nut", f"Brand#{i % 2}") for i in range(301)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    got = queries.topk_union_ties(spark, str(tmp_path))
    pairs_of = {(r.a_id, r.b_id): r.score for r in got.collect()}
    best = {}
    for (a, b), score in pairs_of.items():
        assert a < b and rows[a][2] == rows[b][2] and score == (1 if rows[a][1] == rows[b][1] else score)
        best.setdefault(a, []).append(b)
        best.setdefault(b, []).append(a)
    words = [i for i in range(300) if rows[i][1] != "!"]
    assert sorted(best) == words
    alike = lambda i: [j for j in words if j != i and rows[j][1:] == rows[i][1:]]
    assert {(min(i, j), max(i, j)) for i in words for j in alike(i)[:5]} == set(pairs_of)
    joined = [int(x) for n in _nodes(got) if "Join" in n.nodeName() for x in [n.metrics().apply("numOutputRows").value()]]
    assert joined and max(joined) < 2000  # 62,000 pairs share a word


def _nodes(df):
    """The nodes of the plan that ran."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, out = [plan.executedPlan() if "Adaptive" in plan.nodeName() else plan], []
    while todo:
        n = todo.pop()
        out.append(n)
        if "QueryStage" in n.nodeName():
            todo.append(n.plan())
        todo += [n.children().apply(i) for i in range(n.children().size())]
    return out


def test_prefilter_drops_what_the_score_would_keep(spark):
    df = spark.createDataFrame([(["x"], "1", "2", 0.32, 0.32)], "block array<string>, a_id string, b_id string, tfidf_char double, tfidf_word double")
    items = spark.createDataFrame([(["x"], "1", "q w"), (["x"], "2", "w q")], "block array<string>, id string, text string")
    assert pairs.scored(df, items).first().score == pytest.approx(0.558)  # passes the threshold, but cosines() has left it out
    assert 0.32 < Config().prefilter * Config().lower


def test_without_a_threshold_all_pairs_of_a_block_count(spark):
    assert pairs.candidates(feature_rows(spark, ["aaa", "bbb", "ccc"]), Config(lower=0.0)).count() == 3


def test_batches_and_hydration(spark):
    schema = "pair_id string, a_id string, b_id string, score double, tier string"
    df = spark.createDataFrame([(f"p{i:02}", "T-000", "T-001", 0.5 + (i % 3) / 10, "candidate") for i in range(7)], schema)
    batched = exchange.batches(df, Config(batch_size=3)).cache()
    assert [r.pair_id for r in batched.orderBy("batch_id", F.desc("score"), "pair_id").collect()] == ["p02", "p05", "p01", "p04", "p00", "p03", "p06"]
    assert [tuple(r) for r in exchange.manifest(batched).orderBy("batch_id").collect()] == [(1, "batch_0001.json", "batch_0001.jsonl", 3), (2, "batch_0002.json", "batch_0002.jsonl", 3), (3, "batch_0003.json", "batch_0003.jsonl", 1)]
    assert exchange.hydrated(batched, feature_rows(spark, ["x", "y"])).first().a.name == "x"
    with pytest.raises(Exception, match="no record"):
        exchange.hydrated(batched, feature_rows(spark, ["x"])).collect()
    answered = spark.createDataFrame([(1,), (3,)], "batch_id int")
    assert [r.batch_id for r in exchange.missing_batches(exchange.manifest(batched), answered).collect()] == [2]


def test_verdict_files(spark, tmp_path):
    (tmp_path / "batch_0001.jsonl").write_text('\n{"pair_id": "p", "verdict": "duplicate", "reason": "a"}\nnot json\n[1]\n{"pair_id": ""}\n{"pair_id": "q", "verdict": "wrong"}\n', encoding="utf-8")
    (tmp_path / "batch_0002.jsonl").write_text('{"pair_id": "p", "verdict": "uncertain", "reason": null}\n{"pair_id": "z", "verdict": "duplicate"}\n', encoding="utf-8")
    got = exchange.last_verdicts(files.read_verdicts(spark, str(tmp_path)))
    assert {(r.pair_id, r.verdict, r.reason) for r in got.collect()} == {("p", "uncertain", None), ("z", "duplicate", "")}
    assert files.read_verdicts(spark, str(tmp_path), spark.createDataFrame([(1,), (7,)], "batch_id int")).count() == 1
    (tmp_path / "batch_x.jsonl").write_text("", encoding="utf-8")
    assert sorted(r.batch_id for r in files.answered_batches(spark, str(tmp_path)).collect()) == [1, 2]
    assert files.answered_batches(spark, str(tmp_path / "none")).count() == 0
    assert files.read_verdicts(spark, str(tmp_path / "none")).count() == 0
    candidates = spark.createDataFrame([("p", "1", "2", 0.9, "x"), ("r", "1", "3", 0.8, "x")], "pair_id string, a_id string, b_id string, score double, tier string")
    merged = {r.pair_id: (r.verdict, r.reason) for r in exchange.merge_verdicts(candidates, got).collect()}
    assert merged == {"p": ("uncertain", None), "r": ("uncertain", exchange.NO_VERDICT)}
    assert [r.pair_id for r in exchange.pending_pairs(candidates, got).collect()] == ["r"]


def test_verdict_lines_are_strict(spark):
    good = '{"pair_id": "p", "verdict": "duplicate"}'
    bad = [good + " xyz", f"{good} {good}", f"{good}, {good}", f"{good}] {good}", f'{good}, "y": 1', "{'pair_id': 'p', 'verdict': 'duplicate'}", '{"pair_id": 5, "verdict": "duplicate"}', '{"pair_id": "p", "pair_id": "q"}', good[:-1], "[]", "3", "null", "", "\xa0"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([good, f"\xa0\u2003{good}\t", *bad, '{"pair_id": "p", "verdict": 1, "reason": {"a": 1}}'])] + [(-1, None)], "n int, value string")
    got = sorted(tuple(r) for r in files.parse_verdicts(df).collect())
    assert got == [(0, "p", "duplicate", ""), (1, "p", "duplicate", ""), (2 + len(bad), "p", None, '{"a":1}')]
    text = good + "\r\n" + good + "\x85\u2028" + good + "\x1c" + good + "\x0b\x0c" + good
    assert len(text.splitlines()) == spark.createDataFrame([(text,)], "value string").select(F.split("value", r"\R|[\x{0B}\x{0C}\x{1C}-\x{1E}]").alias("x")).first().x.__len__()


def test_batch_files(spark, tmp_path):
    schema = "pair_id string, a_id string, b_id string, score double, tier string"
    df = spark.createDataFrame([(f"p{i:02}", "T-000", "T-001", 0.5 + (i % 3) / 10, "candidate") for i in range(7)], schema)
    (tmp_path / "batch_0009.json").write_text("old", encoding="utf-8")
    rows = feature_rows(spark, ["x", "y"])
    for _ in range(2):
        files.write_batches(exchange.hydrated(exchange.batches(df, Config(batch_size=3)), rows), str(tmp_path))
        assert sorted(x.name for x in tmp_path.iterdir() if not x.name.startswith(".")) == ["batch_0001.json", "batch_0002.json", "batch_0003.json"]
    first = json.loads((tmp_path / "batch_0001.json").read_text(encoding="utf-8"))
    assert first["batch_id"] == 1 and [p["pair_id"] for p in first["pairs"]] == ["p02", "p05", "p01"]
    assert first["pairs"][0] == {"pair_id": "p02", "score": 0.7, "tier": "candidate", "a": {"id": "T-000", "section": "s", "name": "x", "transfer_types": ["card"]}, "b": {"id": "T-001", "section": "s", "name": "y", "transfer_types": ["card"]}}
    assert exchange.progress(exchange.manifest(exchange.batches(df, Config(batch_size=3)))).first().asDict() == {"total_batches": 3, "total_pairs": 7}


def test_lemma_tables(spark, tmp_path):
    from twinleaf.functions.text import Dictionary
    from twinleaf.operators.lemmas import Remembered

    (tmp_path / "l.json").write_text('{"b": "a", "c": "d"}', encoding="utf-8")
    (tmp_path / "bad.json").write_text('{"b": "a"', encoding="utf-8")
    (tmp_path / "bad").write_text("x", encoding="utf-8")
    assert sorted(map(tuple, files.read_lemmas(spark, str(tmp_path / "l.json")).collect())) == [("b", "a"), ("c", "d")]
    assert all(files.read_lemmas(spark, str(tmp_path / x)).count() == 0 for x in ("bad.json", "bad", "none"))
    path = str(tmp_path / "lemmas")
    df = spark.createDataFrame([("1", ["bs", "x", "bs"]), ("2", [])], "id string, w array<string>")
    for analyse in (lambda t: t.rstrip("s") if t.endswith("s") else None, lambda t: "never"):  # the second time no token is asked for
        made = Remembered(spark, path, analyse)
        assert {r.id: r.w for r in made.apply(df, "w").collect()} == {"1": ["b", "x", "b"], "2": []}
    assert sorted(map(tuple, files.read_lemmas(spark, path).collect())) == [("bs", "b"), ("x", "x")]
    assert Dictionary(files.read_lemmas(spark, path)).digest() != Dictionary(files.read_lemmas(spark, str(tmp_path / "l.json"))).digest()


def test_scopes_delete_what_is_cut_in_them(spark):
    from twinleaf.storage import cut, put, scratch

    there = lambda df: bool(df.inputFiles()) and records.exists(spark, df.inputFiles()[0])
    df = spark.createDataFrame([(1,)], "a int")
    with scratch(spark):
        with scratch(spark):
            inner, kept = cut(df), cut(df, keep=True)
            files_of = inner.inputFiles()
            assert there(inner) and there(kept)
        assert not records.exists(spark, files_of[0]) and kept.first().a == 1
        outer = kept.inputFiles()[0]
    assert not records.exists(spark, outer)
    free = cut(df, keep=True)
    assert there(free)
    assert spark.read.format("binaryFile").load(put(spark, "some.bin", b"\x00\xff")).first().content == b"\x00\xff"


def test_components(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 3), (5, 4), (4, 5), (None, 1)] + [(100 + i, 101 + i) for i in range(40)], "a_id long, b_id long")
    got = {r.node: r.component for r in components.connected_components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4} | {100 + i: 100 for i in range(41)}
    assert components.connected_components(df.limit(0)).count() == 0


VERDICTS = "pair_id string, verdict string, reason string, a_id string, b_id string, score double, tier string"


def test_groups(spark):
    v = spark.createDataFrame([("1", "duplicate", None, "T-000", "T-001", 0.9, ""), ("2", "duplicate", "r", "T-002", "T-001", 0.8, ""), ("3", "uncertain", "u", "T-002", "T-003", 0.7, ""), ("4", "duplicate", "again", "T-001", "T-000", 0.6, "")], VERDICTS)
    f = feature_rows(spark, ["a", "b", "c", "d"])
    found = groups.duplicate_groups(v, f).cache()
    assert [(r["size"], r.member_ids, r.transfer_type_sets, [tuple(e) for e in r.pair_edges]) for r in found.collect()] == [(3, ["T-000", "T-001", "T-002"], [["card"]], [("T-000", "T-001", 0.6, "again"), ("T-001", "T-002", 0.8, "r")])]
    assert groups.totals(found).first().asDict() == {"group_count": 1, "duplicate_pair_count": 2, "largest_group": 3}
    nothing = groups.duplicate_groups(v.where("verdict = 'uncertain'"), f)
    assert groups.totals(nothing).first().asDict() == {"group_count": 0, "duplicate_pair_count": 0, "largest_group": 0}
    assert groups.verdict_counts(v).first().asDict() == {"total_pairs": 4, "n_duplicate": 3, "n_different_transfer_type": 0, "n_different_functionality": 0, "n_uncertain": 1}
    shown = groups.pair_table(v, f.where("id <> 'T-003'"), "uncertain").first()
    assert (shown.score, shown.b_name, shown.a_types) == ("0.700", "?", "card")


def test_plan_has_a_group_limit_and_no_product(spark):
    plan = pairs.candidates(feature_rows(spark, ["a b", "a c"]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("ArrowEvalPython") <= 2


def test_rare_terms_find_every_pair_above_the_threshold(spark):
    import random

    from twinleaf.functions.ngrams import word_grams
    from twinleaf.operators import similarity

    rng = random.Random(2)
    rows = [([f"b{i % 2}"], f"{i:03}", " ".join(rng.choices([f"w{int(40 * rng.random() ** 2)}" for _ in range(30)], k=6))) for i in range(60)]
    items, grams = spark.createDataFrame(rows, "block array<string>, id string, text string"), word_grams(F.col("text"))
    weighted, found = similarity.weights(items, grams).cache(), similarity.vectors(items, grams).cache()
    long = {(r.id, t["term"]): t["w"] for r in found.collect() for t in r.terms}
    assert long == pytest.approx({(r.id, r.term): r.w for r in weighted.collect()})
    records = found.select("block", "id", similarity.shared_terms(F.col("terms")).alias("sim"))
    for least in (0.05, 0.1, 0.2):
        want = {(r.a_id, r.b_id): r.sim for r in similarity.cosine_pairs(weighted).collect() if r.sim >= least + 1e-6}
        some = similarity.likely_pairs(found, least).distinct()
        got = {(r.a_id, r.b_id): r.sim for r in similarity.cosines_of(some, records, ["sim"]).collect()}
        assert want.keys() <= got.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items()) and want


def test_every_cosine_is_that_of_the_join(spark, monkeypatch):
    import random

    from twinleaf.functions.ngrams import char_grams
    from twinleaf.operators import similarity

    rng = random.Random(3)
    names = ["red bolt"] * 200 + ["".join(rng.choices("abc ", k=8)) for _ in range(150)] + ["", " ", "zzz", "яя", "red  bolt"]
    rows = [([f"b{i % 3 // 2}"], str(i), t) for i, t in enumerate(names)]
    rows += [(["b0"], "0", "abc"), (["b0"], "0", "red bolt"), (["b1"], "0", "red bolt")]  # an id that is there more than once
    items, grams = spark.createDataFrame(rows, "block array<string>, id string, text string"), char_grams(F.col("text"))
    want = {(r.block[0], r.a_id, r.b_id): r.sim for r in similarity.cosine_pairs(similarity.weights(items, grams)).collect()}
    assert len(want) > 10000
    for whole, copies in ((24, 64), (2, 7)):  # one chunk, and up to eight
        monkeypatch.setattr(similarity, "WHOLE", whole)
        monkeypatch.setattr(similarity, "COPIES", copies)
        got = [(r.a_id, r.b_id, r.sim) for r in similarity.every_cosine(items, grams).collect()]
        assert sorted((a, b) for a, b, _ in got) == sorted((a, b) for _, a, b in want)
        block = {}
        for (k, a, b), sim in want.items():
            block.setdefault((a, b), []).append(sim)
        assert all(min(abs(sim - x) for x in block[a, b]) < 1e-12 for a, b, sim in got)
    assert similarity.every_cosine(items.limit(0), grams).count() == 0 and similarity.every_cosine(items.where("text in ('', 'zzz')"), grams).count() == 0


def test_every_cosine_holds_little_at_once(monkeypatch):
    import random

    import pyarrow as pa

    from twinleaf.operators import similarity

    rng, vectors = random.Random(4), []
    for i in range(20):
        vectors.append({"ids": [f"{i}-{k}" for k in range(rng.randint(1, 4))], "v": {f"t{k}": rng.random() + 0.1 for k in rng.sample(range(15), rng.randint(1, 5))}, "chunk": i % 2})
    for lo, hi in ((0, 0), (0, 1)):
        of = [r for r in vectors if r["chunk"] in (lo, hi)]
        rows = [{"block": ["b"], "ids": r["ids"], "terms": list(r["v"]), "ws": list(r["v"].values()), "chunk": r["chunk"], "lo": lo, "hi": hi} for r in of]
        want = {}
        for i, x in enumerate(of):
            for y in of[i:]:
                both = x["v"].keys() & y["v"].keys()
                if both and (lo == hi or x["chunk"] != y["chunk"]):
                    want |= {(min(a, b), max(a, b)): sum(x["v"][t] * y["v"][t] for t in both) for a in x["ids"] for b in y["ids"] if a != b}
        for most in (1, 9, 1 << 20):
            for name in ("CELLS", "PRODUCTS", "ROWS"):
                monkeypatch.setattr(similarity, name, most)
            out = list(similarity._every(iter(pa.Table.from_pylist(rows).to_batches(max_chunksize=3))))
            got = [tuple(r.values()) for b in out for r in b.to_pylist()]
            assert len(got) == len(want) and {(a, b): sim for a, b, sim in got} == pytest.approx(want)
            assert max(b.num_rows for b in out) <= max(most, 16)


def test_char_cosines_take_no_row_for_a_shared_term(spark):
    from tests.test_whole import compared
    from twinleaf.plans import queries

    found, d = [], "/root/testdata/sf0.01"

    def query(*a):
        found.append(queries.cosine_pairs_char(*a))
        return found[0]

    compared(spark, "cosine_pairs_char", query, queries.oracle_sql()["cosine_pairs_char"], d)
    found[0].collect()
    joined = [n.metrics().apply("numOutputRows").value() for n in _nodes(found[0]) if "Join" in n.nodeName()]
    assert joined and max(joined) < 1000  # a join of terms makes 36,705 at once


def test_no_growing_table_is_broadcast(spark, monkeypatch):
    """Of lookalike_pairs: what is joined by an id, a text or a term is merged, whatever the planner takes its size for; tables of a row per block or section may be sent."""
    from twinleaf import storage
    from twinleaf.plans import queries

    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(pairs, "cut", lambda df, **k: plans.append(plan(df)) or storage.cut(df, **k))
    plans.append(plan(queries.lookalike_pairs(spark, "/root/testdata/sf0.001")))
    items = spark.createDataFrame([(["b"], "1", "red ball")], "block array<string>, id string, text string")
    plans.append(plan(similarity.vectors(items, F.split("text", " "))))
    plans.append(plan(pairs.candidates(feature_rows(spark, ["red ball", "red balls"]))))
    keys = re.findall(r"BroadcastHashJoin \[([^]]*)\]", "\n".join(plans))
    assert {re.sub(r"#\d+L?", "", k) for k in keys} <= {"block"}
    assert "SortMergeJoin" in plans[-1]
