"""Lexicon matching, tokens, lemmas, n-grams, fuzzy ratios: behaviour on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from twinleaf.functions import lexicon, ngrams, text
from twinleaf.functions.fuzzy import lcs_length, token_set_ratio
from twinleaf.functions.lexicon import RUSSIAN


def rows(spark, values, *columns):
    """The columns' values for each text, in order."""
    df = spark.createDataFrame(list(enumerate(values)), "k int, t string")
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in df.select("k", *columns).orderBy("k").collect()]


def test_yo_is_folded(spark):
    assert rows(spark, ["ёлка Ёж", None], lexicon.fold_yo(F.col("t"))) == ["елка Еж", None]


def test_labels_on_raw_text(spark):
    given = ["по номеру телефона", "через СБП", "между своими счетами", "sbpanel qrtool", "оплата по QR-коду", "card to card", "счётчик", None, ""]
    found = rows(spark, given, lexicon.labels_of(F.col("t"), RUSSIAN))
    assert found == [["phone"], ["sbp"], ["account", "self"], [], ["qr"], ["c2c", "card"], ["account"], [], []]


def test_markers_count_patterns_not_places(spark):
    assert rows(spark, ["лимиты и комиссии", "лимит лимит", "без признаков"], lexicon.marker_count(F.col("t"), RUSSIAN)) == [2, 1, 0]


def test_digests_follow_the_content():
    other = lexicon.Lexicon({**RUSSIAN.labels, "x": ["x"]}, RUSSIAN.markers, RUSSIAN.stopwords)
    assert other.digest() != RUSSIAN.digest() and len(RUSSIAN.digest()) == len(RUSSIAN.stopwords_digest()) == 16


def test_stems_come_from_the_patterns(spark):
    assert {"номер", "телефон"} <= set(RUSSIAN.stems("phone"))
    df = spark.createDataFrame([(["перевод", "телефон", "номер", "друг"],)], "l array<string>")
    assert df.select(lexicon.strip_labels(F.col("l"), RUSSIAN)).first()[0] == ["перевод", "друг"]


def test_trim_and_path(spark):
    got = rows(spark, [" Переводы /  По номеру / ", None, "a/b", " x "], text.path_segments(F.col("t"), " / "))
    assert got == [["Переводы", "По номеру"], [], ["a/b"], ["x"]]
    assert rows(spark, ["a.b", "a|b"], text.path_segments(F.col("t"), ".")) == [["a", "b"], ["a|b"]]


def test_tokens_and_content(spark):
    assert rows(spark, ["Card-to-Card, ёж 3DS²"], text.tokens(F.col("t"))) == [["card-to-card", "еж", "3ds²"]]
    got = rows(spark, ["Проверка 123 на x² ² карту а б вг ½"], text.content_tokens(F.col("t"), RUSSIAN))
    assert got == [["x²", "карту", "вг"]]


def test_lemmas_keep_order_and_repeats(spark):
    df = spark.createDataFrame([("1", "карты карту по карте"), ("2", ""), ("3", None)], "id string, t string")
    table = spark.createDataFrame([("карты", "карта"), ("карту", "карта"), ("карте", "по")], "token string, lemma string")
    joined = {r.id: r.l for r in text.with_lemmas(df, "t", "l", RUSSIAN, text.Dictionary(table)).collect()}
    assert joined == {"1": ["карта", "карта"], "2": [], "3": []}
    literal = {r.id: r.l for r in text.with_lemmas(df, "t", "l", RUSSIAN, text.Literal({"карты": "карта", "карту": "карта", "карте": "по"})).collect()}
    assert literal == joined


def test_secondary_key_hash_and_cleaning(spark):
    df = spark.createDataFrame([(["A", "БЁ"], [" X ", "x", "", None, "а"]), ([], None)], "s array<string>, v array<string>")
    got = df.select(text.secondary_key(F.col("s")), text.cleaned_labels(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [("бё", ["x", "а"]), ("", [])]
    assert rows(spark, ["abc"], text.short_hash(F.col("t"))) == ["ba7816bf8f01cfea"]


def plain_char_grams(t):
    out = []
    for w in t.lower().split():
        w = f" {w} "
        out += [w[i : i + n] for n in range(3, 6) if n <= len(w) for i in range(len(w) - n + 1)]
    return out


def test_grams(spark):
    given = ["Ab cde", "я", "", "раз-два  три"]
    assert rows(spark, given, ngrams.char_grams(F.col("t"))) == [plain_char_grams(t) for t in given]
    assert rows(spark, ["a b-c d", "", None, "x"], ngrams.word_grams(F.col("t"))) == [["a", "b", "c", "d", "a b", "b c", "c d"], [], [], ["x"]]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def test_lcs_against_the_table():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choices("abcé ", k=rng.randint(0, 90))) for _ in range(2))
        assert lcs_length(a, b) == plain_lcs(a, b)


@pytest.mark.parametrize(("a", "b", "want"), [("a b", "b a", 1.0), ("a", "a b", 1.0), ("", "a", 0.0), (None, None, 0.0), ("abc", "abd", 2 / 3), ("x abc", "x abd", 0.8)])
def test_token_set_ratio(a, b, want):
    assert token_set_ratio(a, b) == pytest.approx(want) == token_set_ratio(b, a)
