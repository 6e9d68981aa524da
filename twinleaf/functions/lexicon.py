"""Lexicons: labels with their patterns, feature markers and stopwords. A lexicon is data; the functions compile it to columns."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lexicon:
    labels: dict[str, list[str]]
    markers: list[str]
    stopwords: frozenset[str] = field(default_factory=frozenset)

    def digest(self) -> str:
        """Of labels in sorted order with their patterns in given order, then markers."""
        text = "".join([*(x for k in sorted(self.labels) for x in (k, *self.labels[k])), *self.markers])
        return hashlib.sha256(text.encode()).hexdigest()[:16]

    def stopwords_digest(self) -> str:
        return hashlib.sha256("".join(sorted(self.stopwords)).encode()).hexdigest()[:16]

    def stems(self, label: str) -> list[str]:
        """Words of three letters or more in the text of a label's patterns (an escape's letter sticks to what follows it)."""
        return sorted({w.lower() for p in self.labels[label] for w in re.findall(r"[^\W_]+", p) if len(w) >= 3})


def fold_yo(x: Column) -> Column:
    return F.translate(x, "ёЁ", "еЕ")


def _any_of(patterns: list[str]) -> Column:
    return F.lit("(?iU)(?:" + "|".join(patterns) + ")")


def labels_of(text: Column, lexicon: Lexicon) -> Column:
    """Sorted labels of which some pattern occurs in the text (null: none)."""
    text = fold_yo(F.coalesce(text, F.lit("")))
    found = F.array(*[F.when(F.regexp_like(text, _any_of(p)), F.lit(label)) for label, p in sorted(lexicon.labels.items())])
    return F.array_compact(found)


def marker_count(text: Column, lexicon: Lexicon) -> Column:
    """How many marker patterns occur at least once."""
    text = fold_yo(F.coalesce(text, F.lit("")))
    total = F.lit(0)
    for p in lexicon.markers:
        total = total + F.regexp_like(text, _any_of([p])).cast("int")
    return total


def strip_labels(lemmas: Column, lexicon: Lexicon) -> Column:
    """Lemmas without those that start with, or begin, a stem of a label found in the joined lemmas."""
    found = labels_of(F.array_join(lemmas, " "), lexicon)
    stems = F.flatten(F.array(*[F.when(F.array_contains(found, label), F.array(*map(F.lit, lexicon.stems(label)))).otherwise(F.array().cast("array<string>")) for label in sorted(lexicon.labels)]))
    return F.filter(lemmas, lambda x: ~F.exists(stems, lambda w: F.startswith(x, w) | F.startswith(w, x)))


# The label patterns, markers and stopwords of Russian bank-transfer titles.
RUSSIAN_LABELS: dict[str, list[str]] = {
    "phone": [r"\bпо\s+номер\w*\s+телефон\w*", r"\bномер\w*\s+телефон\w*", r"\bна\s+телефон\w*", r"\bтелефон\w*", r"\bphone\b", r"\bmobile\b"],
    "sbp": [r"\bсбп\b", r"\bсистем\w*\s+быстр\w*\s+платеж\w*", r"\bsbp\b", r"\bfps\b"],
    "card": [r"\bна\s+карт\w*", r"\bпо\s+номер\w*\s+карт\w*", r"\bномер\w*\s+карт\w*", r"\bкарт\w*", r"\bcard\b", r"\bpan\b"],
    "c2c": [r"\bc2c\b", r"\bкарт\w*[\s\-]+карт\w*", r"\bс\s+карт\w*\s+на\s+карт\w*", r"\bcard[\s\-]+to[\s\-]+card\b"],
    "account": [r"\bпо\s+реквизит\w*", r"\bреквизит\w*", r"\bна\s+сч[её]т\b", r"\bсч[её]т\w*", r"\bбик\b", r"\bbic\b", r"\bрасч[её]тн\w*\s+сч[её]т\w*", r"\bр/с\b", r"\bswift\b", r"\baccount\b"],
    "wallet": [r"\bкошел[её]к\w*", r"\bэлектронн\w*\s+кошел[её]к\w*", r"\bwallet\b", r"\bqiwi\b", r"\byoomoney\b", r"\bюmoney\b"],
    "self": [r"\bмежду\s+свои\w*", r"\bсвои\s+сч[её]т\w*", r"\bперевод\s+себе\b", r"\bself[\s\-]+transfer\b", r"\bown\s+account\w*"],
    "internal": [r"\bвнутрибанковск\w*", r"\bвнутри\s+банк\w*", r"\bвнутренн\w*\s+перевод\w*", r"\bintrabank\b"],
    "external": [r"\bв\s+друг\w*\s+банк\w*", r"\bмежбанковск\w*", r"\binterbank\b"],
    "international": [r"\bмеждународн\w*", r"\bза\s+рубеж\b", r"\bвалютн\w*\s+перевод\w*", r"\binternational\b", r"\bcurrency\s+transfer\b"],
    "qr": [r"\bqr\b", r"\bпо\s+qr\b", r"\bqr[\s\-]+код\w*"],
    "template": [r"\bпо\s+шаблон\w*", r"\bшаблон\w*", r"\btemplate\b"],
    "recurring": [r"\bавтоплат[её]ж\w*", r"\bрегулярн\w*\s+перевод\w*", r"\brecurring\b", r"\bstanding\s+order\b"],
}
RUSSIAN_MARKERS: list[str] = [
    r"\bлимит\w*", r"\bкомисс\w*", r"\bвалидац\w*", r"\bнегативн\w*", r"\bпозитивн\w*", r"\bnegative\b", r"\bpositive\b", r"\bсмоук\w*", r"\bsmoke\b", r"\bрегресс\w*", r"\bregression\b",
    r"\bfee\b", r"\bистори\w*", r"\bуведомлен\w*", r"\bpush\b", r"\bsms\b", r"\b3ds\b", r"\botp\b", r"\bподтвержд\w*", r"\bавторизац\w*", r"\bотмен\w*", r"\bвозврат\w*", r"\bповтор\w*",
    r"\bчерновик\w*", r"\bdraft\b", r"\bизбранн\w*", r"\bfavorit\w*", r"\bполучател\w*", r"\brecipient\w*", r"\bпоиск\w*", r"\bфильтр\w*",
]
RUSSIAN_STOPWORDS = """
и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только её мне было вот от меня ещё
нет о из ему теперь когда даже ну вдруг ли если уже или ни быть был него до вас нибудь опять уж вам ведь там потом
себя ничего ей может они тут где есть надо ней для мы тебя их чем была сам чтоб без будто чего раз тоже себе под
будет ж тогда кто этот того потому этого какой совсем ним здесь этом один почти мой тем чтобы нее сейчас были куда
зачем всех никогда можно при наконец два об другой хоть после над больше тот через эти нас про всего них какая много
разве три эту моя впрочем хорошо свою этой перед иногда лучше чуть том нельзя такой им более всегда конечно всю между
"""
ENGLISH_STOPWORDS = "a an the is are was were be been being to of in on at for by with from as and or if when then this that these those it its"
TITLE_NOISE = """
тест тесты проверка проверки проверить проверяется кейс кейсы case tc tests сценарий сценарии scenario пользователь
пользователи клиент клиенты user приложение приложении app
"""

RUSSIAN = Lexicon(RUSSIAN_LABELS, RUSSIAN_MARKERS, frozenset((RUSSIAN_STOPWORDS + ENGLISH_STOPWORDS + TITLE_NOISE).split()))

#: A small lexicon for web pages, by which the registered queries label sections (from addresses) and titles.
PAGES = Lexicon({"company": [r"\bcom\b"], "organisation": [r"\borg\b"], "inner": [r"\bin\w*\s+th\w*", r"\binto\b"]}, [r"\bhttps\b", r"\bspam\w*", r"\bads\b"], frozenset(["the", "of", "and", "de", "la", "die", "example"]))
