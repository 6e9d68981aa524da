"""The Markdown report, written from the report's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinleaf.operators import groups as g


def render(records: DataFrame, features: DataFrame, verdicts: DataFrame, groups: DataFrame, sections: DataFrame) -> str:
    """The report's text. It is read by people, so its tables are collected."""
    s = g.summary(records, verdicts, groups, sections).first().asDict()
    ordered = g.in_order(groups)
    members: dict[int, list] = {}
    for r in g.member_table(ordered, features).orderBy("number", "id").collect():
        members.setdefault(r.number, []).append(r)
    edges: dict[int, list] = {}
    for r in g.evidence_table(ordered).orderBy("number", "a_id", "b_id").collect():
        edges.setdefault(r.number, []).append(r)
    out = ["# Duplicate report", "", "## Summary", ""]
    out += [f"- {k.replace('_', ' ')}: {v}" for k, v in s.items()]
    out += ["", "## Duplicate groups", ""]
    for number, rows in sorted(members.items()):
        types = sorted({r.types for r in rows})
        out += [f"### Group {number} ({len(rows)} records, {{{'; '.join(types)}}})", ""]
        out += [f"- `{r.id}` {r.name} ({r.section})" for r in rows]
        out += ["", "Evidence:", ""] + [f"- `{e.a_id}` and `{e.b_id}`, {e.score}: {e.reason}" for e in edges.get(number, [])] + [""]
    for title, verdict in (("Uncertain pairs", "uncertain"), ("Lookalikes of different transfer types", "different_transfer_type")):
        out += [f"## {title}", "", "| a | b | score | types | reason |", "|-|-|-|-|-|"]
        out += [f"| {r.a_id} {r.a_name} | {r.b_id} {r.b_name} | {r.score} | {r.a_types} / {r.b_types} | {r.reason} |" for r in g.pair_table(verdicts, features, verdict).orderBy("pair_id").collect()] + [""]
    out += ["## Sections not settled by rules", "", "| section | category | source | reason |", "|-|-|-|-|"]
    out += [f"| {r.section_path} | {r.category} | {r.source} | {r.reason or ''} |" for r in g.unsettled_sections(sections).orderBy("section_path").collect()]
    return "\n".join(out) + "\n"


def write(spark: SparkSession, text: str, path: str) -> None:
    """One file at the path, on any file system that Spark writes."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
