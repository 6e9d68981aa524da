"""Command line: one command per step, run-all and clean."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from twinleaf.config import Config
from twinleaf.functions.text import Dictionary
from twinleaf.plans.pipeline import DONE, NEEDS_SECTION_LABELS, Pipeline
from twinleaf.sources.exchange import read_lemmas
from twinleaf.sources.records import exists

COMMANDS = ["parse", "classify-auto", "classify-merge", "features", "candidates", "batch-pairs", "merge-verdicts", "cluster", "report", "run-all", "clean"]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="twinleaf", description=__doc__)
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--input", default="data/input.tsv", help="TSV file with id, section, name")
    p.add_argument("--work", default="artifacts", help="folder of the stages' tables")
    p.add_argument("--section-sep", default=Config.section_sep)
    p.add_argument("--lemmas", help="lemma table: Parquet with token and lemma, or a JSON object; by default lemmas or lemmas.json of the work folder, if there")
    p.add_argument("--force", action="store_true", help="ignore stored stages")
    p.add_argument("--deep", action="store_true", help="clean: also the lemma table and outside answers")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("twinleaf").getOrCreate()
    if a.lemmas and not exists(spark, a.lemmas):
        raise FileNotFoundError(a.lemmas)
    run = Pipeline(spark, a.work, Config(section_sep=a.section_sep), lemmatizer=Dictionary(read_lemmas(spark, a.lemmas)) if a.lemmas else None, force=a.force)
    if a.command == "parse":
        run.parse(a.input)
        run.sections()
    elif a.command == "run-all":
        state = run.run(a.input)
        if state != DONE:
            waits = f"{run.path('section_labels.json')} with labels of the ambiguous sections" if state == NEEDS_SECTION_LABELS else f"{run.missing_batches().count()} files {run.path('verdicts')}/batch_NNNN.jsonl"
            print(f"{state}: waiting for {waits}", file=sys.stderr)
    elif a.command == "clean":
        run.clean(a.deep)
    else:
        made = getattr(run, a.command.replace("-", "_"))()
        if a.command == "merge-verdicts":
            missing, pairs = run.missing_batches().orderBy("batch_id"), run.pending().count()
            if pairs:
                print(f"warning: {missing.count()} batches have no verdict file (first: {[r.batch_id for r in missing.take(5)]}); {pairs} pairs without a verdict count as uncertain", file=sys.stderr)
        elif isinstance(made, str):
            print(made)
    return 0


if __name__ == "__main__":
    sys.exit(main())
