"""The whole pipeline over a TSV file and a work folder, with cached stages and two gates for outside answers."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinleaf.config import Config
from twinleaf.functions.lexicon import RUSSIAN, Lexicon
from twinleaf.functions.text import Dictionary, Identity, Lemmatizer
from twinleaf.operators import classify, exchange, features, groups, pairs
from twinleaf.plans import report
from twinleaf.sources import exchange as files
from twinleaf.sources import records as source
from twinleaf.storage import cut, remove

NEEDS_SECTION_LABELS, NEEDS_VERDICTS, DONE = "NEEDS_SECTION_LABELS", "NEEDS_VERDICTS", "DONE"


#: Stages and the columns by which their tables are sorted.
STAGES = {"tests": "id", "sections": "section", "classified": "section_path", "sections_final": "section_path", "features": "id", "candidates": "pair_id", "batched": "pair_id", "verdicts_final": "pair_id", "groups": "member_ids"}


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's rows that does not depend on their order (and of nothing else, such as dates of writing)."""
    row = df.agg(F.count("*"), F.sum(F.xxhash64(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})).cast("decimal(38,0)"))).first()
    return f"{row[0]}-{row[1]}"


@dataclass
class Pipeline:
    """Steps by name; each reads the tables of those before it from the work folder and writes its own, sorted.

    Without a lemmatizer, lemmas come from the table `lemmas` (or `lemmas.json`) of the
    work folder, if there is one. A labeller or an arbiter answers what otherwise
    outside files have to.
    """

    spark: SparkSession
    work: str
    config: Config = Config()
    lexicon: Lexicon = RUSSIAN
    lemmatizer: Lemmatizer | None = None
    force: bool = False
    labeller: classify.SectionLabeller | None = None
    arbiter: exchange.PairArbiter | None = None
    ran: list[str] = field(default_factory=list)

    def __post_init__(self):
        if self.lemmatizer is None:
            found = [x for x in ("lemmas", "lemmas.json") if source.exists(self.spark, f"{self.work}/{x}")]
            self.lemmatizer = Dictionary(files.read_lemmas(self.spark, f"{self.work}/{found[0]}")) if found else Identity()

    # ---- stored stages

    def path(self, name: str) -> str:
        return f"{self.work}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def meta(self, name: str) -> dict:
        """The stage's note; empty if there is none or it can't be read."""
        path = self.path(f"{name}.meta.json")
        if not source.exists(self.spark, path) or not source.exists(self.spark, self.path(name)):
            return {}
        try:
            return json.loads(self.spark.read.text(path, wholetext=True).first()[0])
        except (ValueError, TypeError):
            return {}

    def stage(self, name: str, inputs: list[str], make) -> DataFrame:
        """The stage's table: the stored one if inputs, lexicon, lemmatizer and settings are what made it, else a new one.

        inputs: fingerprints. The new table is finished before the old one goes.
        """
        key = {"stage": name, "input_hash": "|".join(inputs), "lexicon_hash": self.lexicon.digest() + self.lexicon.stopwords_digest(), "lemmatizer_hash": self.lemmatizer.digest(), "config_hash": self.config.digest()}
        held = self.meta(name)
        if self.force or any(held.get(k) != v for k, v in key.items()):
            made = cut(make())
            made.orderBy(STAGES[name]).write.mode("overwrite").parquet(self.path(name))
            content = fingerprint(made)
            note = key | {"content": content, "count": int(content.split("-")[0]), "created_at": datetime.now(UTC).isoformat()}
            report.write(self.spark, json.dumps(note, sort_keys=True, indent=2), self.path(f"{name}.meta.json"))
            remove(self.spark, made)
            self.ran.append(name)
        return self.table(name)

    def content(self, name: str) -> str:
        return self.meta(name).get("content", "")

    # ---- steps

    def parse(self, path: str) -> DataFrame:
        raw = source.read_records(self.spark, path)
        return self.stage("tests", [fingerprint(raw)], lambda: classify.parse_records(raw, self.config))

    def sections(self) -> DataFrame:
        return self.stage("sections", [self.content("tests")], lambda: classify.section_profile(self.table("tests")))

    def classify_auto(self) -> DataFrame:
        return self.stage("classified", [self.content("sections")], lambda: classify.classify_sections(self.sections(), self.lexicon, self.lemmatizer))

    def split(self) -> tuple[DataFrame, DataFrame]:
        return classify.route(self.table("classified"), self.config)

    def section_labels(self) -> DataFrame:
        """Of the file, if it is there; else of the labeller, if there is one; else none."""
        path = self.path("section_labels.json")
        return self.labeller(self.split()[1]) if self.labeller and not source.exists(self.spark, path) else files.read_section_labels(self.spark, path)

    def classify_merge(self) -> DataFrame:
        labels = self.section_labels()
        return self.stage("sections_final", [self.content("classified"), fingerprint(labels)], lambda: classify.merge_labels(*self.split(), labels))

    def features(self) -> DataFrame:
        return self.stage("features", [self.content("tests"), self.content("sections_final")], lambda: features.feature_table(self.table("tests"), self.table("sections_final"), self.lexicon, self.lemmatizer))

    def candidates(self) -> DataFrame:
        return self.stage("candidates", [self.content("features")], lambda: pairs.candidates(self.table("features"), self.config))

    def batch_pairs(self) -> DataFrame:
        batched = self.stage("batched", [self.content("candidates")], lambda: exchange.batches(self.table("candidates"), self.config))
        files.write_batches(exchange.hydrated(batched, self.table("features")), self.path("batches"))
        exchange.manifest(batched).orderBy("batch_id").write.mode("overwrite").parquet(self.path("manifest"))
        return batched

    def verdicts(self) -> DataFrame:
        """Of the verdict files that the manifest names; the arbiter's, if there is one, for pairs of other batches."""
        given = files.read_verdicts(self.spark, self.path("verdicts"), self.table("manifest"))
        if self.arbiter:
            open_ = self.table("batched").join(self.missing_batches().select("batch_id"), "batch_id", "left_semi")
            given = given.unionByName(self.arbiter(open_, self.table("features")).select(*given.columns))
        return given

    def missing_batches(self) -> DataFrame:
        """Rows of the manifest whose verdict file is not there."""
        return exchange.missing_batches(self.table("manifest"), files.answered_batches(self.spark, self.path("verdicts")))

    def pending(self) -> DataFrame:
        """Pairs without a verdict."""
        return exchange.pending_pairs(self.table("batched"), self.verdicts())

    def merge_verdicts(self) -> DataFrame:
        given = self.verdicts()
        return self.stage("verdicts_final", [self.content("candidates"), fingerprint(given)], lambda: exchange.merge_verdicts(self.table("candidates"), given))

    def cluster(self) -> DataFrame:
        return self.stage("groups", [self.content("verdicts_final"), self.content("features")], lambda: groups.duplicate_groups(self.table("verdicts_final"), self.table("features")))

    def report(self) -> str:
        text = report.render(self.table("tests"), self.table("features"), self.table("verdicts_final"), self.table("groups"), self.table("sections_final"))
        report.write(self.spark, text, self.path("duplicates_report.md"))
        return text

    def run(self, path: str) -> str:
        """All steps as far as outside answers allow: NEEDS_SECTION_LABELS, NEEDS_VERDICTS or DONE.

        Every batch needs a verdict file; pairs that it leaves out, or answers wrongly, are uncertain.
        """
        self.parse(path)
        self.sections()
        self.classify_auto()
        if not self.labeller and not source.exists(self.spark, self.path("section_labels.json")) and not self.split()[1].isEmpty():
            return NEEDS_SECTION_LABELS
        self.classify_merge()
        self.features()
        self.candidates()
        self.batch_pairs()
        if not self.arbiter and not self.missing_batches().isEmpty():
            return NEEDS_VERDICTS
        self.merge_verdicts()
        self.cluster()
        self.report()
        return DONE

    def clean(self, deep: bool = False) -> None:
        """Remove what the steps made; the lemma table and outside answers stay unless deep, and so does the input."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path
        gone = [*STAGES, *(f"{n}.meta.json" for n in STAGES), "batches", "manifest", "duplicates_report.md", *(["lemmas", "lemmas.json", "section_labels.json", "verdicts"] if deep else [])]
        for name in gone:
            p = fs_path(self.path(name))
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
