"""A report of one run as a self-contained HTML page; only roll-ups and a few samples come to the driver."""

from __future__ import annotations

import html
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.metrics import rollups
from corpusmill.metrics.store import MetricsStore
from corpusmill.operators.base import DETAILS


#: Characters of a text that a preview shows.
PREVIEW = 500


def preview(df: DataFrame) -> Column:
    """A row as JSON for people: without columns that begin with _, long texts cut, bytes as their number."""
    parts = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if f.name.startswith("_"):
            continue
        if isinstance(f.dataType, T.BinaryType):
            value = F.when(value.isNotNull(), F.concat(F.lit("<binary: "), F.length(value).cast("string"), F.lit(" bytes>")))
        elif isinstance(f.dataType, T.StringType):
            value = F.when(F.length(value) > PREVIEW, F.concat(F.substring(value, 1, PREVIEW), F.lit("..."))).otherwise(value)
        parts.append(value.alias(f.name))
    return F.to_json(F.struct(*parts)) if parts else F.lit("{}")


def duplicate_groups(rejected: DataFrame, groups: int = 10, members: int = 5) -> DataFrame:
    """The largest groups of duplicates of each operator: operator, dedup_key, duplicates, representative_id, samples, and the
    operator's total_duplicates and total_groups. samples: the JSON of at most so many duplicates, the least by value.

    Rows without a key are left out. Counts are combined before the shuffle; only rows of the chosen groups are sampled.
    """
    d = F.col(DETAILS)
    rows = rejected.where(F.coalesce(F.length(d["dedup_key"]), F.lit(0)) > 0).select(d["operator"].alias("operator"), d["dedup_key"].alias("dedup_key"), d["representative_id"].alias("who"), preview(rejected).alias("record"))
    sizes = rows.groupBy("operator", "dedup_key").agg(F.count("*").alias("duplicates"), F.coalesce(F.min("who"), F.lit("(not tracked)")).alias("representative_id"))
    totals = sizes.groupBy("operator").agg(F.sum("duplicates").alias("total_duplicates"), F.count("*").alias("total_groups"))
    w = Window.partitionBy("operator").orderBy(F.desc("duplicates"), "dedup_key")
    top = sizes.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= groups).drop("_n")
    own = rows.join(F.broadcast(top.select("operator", "dedup_key")), ["operator", "dedup_key"])
    few = own.withColumn("_n", F.row_number().over(Window.partitionBy("operator", "dedup_key").orderBy("record"))).where(F.col("_n") <= members)
    shown = few.groupBy("operator", "dedup_key").agg(F.sort_array(F.collect_list("record")).alias("samples"))
    return top.join(shown, ["operator", "dedup_key"]).join(totals, "operator")


def samples(rejected: DataFrame, per_operator: int = 20) -> DataFrame:
    """At most so many rejected rows of each operator as JSON, the first by a hash of the row."""
    body = preview(rejected)
    rows = rejected.select(F.col(f"{DETAILS}.operator").alias("operator"), F.col(f"{DETAILS}.reason").alias("reason"), body.alias("record"))
    w = Window.partitionBy("operator").orderBy(F.xxhash64("record"), "record")
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_operator).drop("_n")


def _table(title: str, df: DataFrame) -> str:
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{html.escape(f'{v:,.3f}' if isinstance(v, float) else str(v))}</td>" for v in r) + "</tr>" for r in df.collect())
    return f"<h2>{html.escape(title)}</h2><table><tr>{head}</tr>{body}</table>"


def _cards(run: dict) -> str:
    shown = (("Input", f"{run['total_input_records']:,}"), ("Output", f"{run['total_output_records']:,}"), ("Pass rate", f"{run['overall_pass_rate']:.2f}%"), ("Seconds", f"{run['duration']:.2f}"), ("Records a second", f"{run['avg_throughput']:,.0f}"), ("Errors", f"{run['total_errors']:,}"))
    return "<div class='cards'>" + "".join(f"<div><b>{value}</b><span>{title}</span></div>" for title, value in shown) + "</div>"


def _bars(title: str, values: list[tuple[str, float | None]], form: str = "{:,.2f}") -> str:
    """Horizontal bars as inline SVG; values that nothing measured are left out."""
    known = [(n, v) for n, v in values if v is not None]
    if not known:
        return ""
    most, line = max(v for _, v in known) or 1.0, 24
    rows = []
    for i, (name, v) in enumerate(known):
        wide, text = max(1.0, 360 * v / most), html.escape(name)
        rows.append(f"<text x='190' y='{i * line + 15}' text-anchor='end'>{text}</text><rect x='200' y='{i * line + 3}' width='{wide:.1f}' height='{line - 8}' rx='2'><title>{text}: {form.format(v)}</title></rect><text x='{206 + wide:.1f}' y='{i * line + 15}'>{form.format(v)}</text>")
    return f"<h2>{html.escape(title)}</h2><svg role='img' aria-label='{html.escape(title)}' width='680' height='{len(known) * line + 4}'>{''.join(rows)}</svg>"


def render(store: MetricsStore, run_id: str | None = None, rejected: DataFrame | None = None, per_operator: int = 20) -> str:
    run_id = run_id or store.latest()
    if run_id is None:
        raise ValueError("there are no runs")
    operators, stages, runs = (store.read(t, run_id) for t in ("operators", "stages", "runs"))
    of = [r.asDict() for r in rollups.operator_rollup(operators).orderBy("stage_name", "first_seen").collect()]
    steps = [r.asDict() for r in stages.orderBy("timestamp", "stage_name").collect()]
    charts = [
        _bars("Records that each operator passes on", [(f"{r['stage_name']}/{r['operator_name']}", r["output_records"]) for r in of], "{:,.0f}"),
        _bars("Pass rate of each operator, %", [(r["operator_name"], r["pass_rate"]) for r in of]),
        _bars("Throughput of each operator, records a second", [(r["operator_name"], r["avg_throughput"]) for r in of], "{:,.0f}"),
        _bars("Mean latency of each operator, seconds a record", [(r["operator_name"], r["avg_latency"]) for r in of], "{:.6f}"),
        _bars("Seconds of each stage", [(r["stage_name"], r["total_time"]) for r in steps]),
        _bars("Pass rate of each stage, %", [(r["stage_name"], r["pass_rate"]) for r in steps]),
    ]
    parts = [_cards(r.asDict()) for r in runs.limit(1).collect()] + charts
    parts += [_table("Run", runs.drop("config")), _table("Stages", stages.orderBy("timestamp", "stage_name")), _table("Operators", rollups.operator_rollup(operators).orderBy("stage_name", "first_seen")), _table("Funnel", rollups.funnel(operators)), _table("Timeline", rollups.timeline(stages)), _table("Waterfall", rollups.waterfall(stages)), _table("Bottlenecks", rollups.bottleneck(stages, operators)), _table("Latency", rollups.latency_heatmap(operators))]
    if rejected is not None:
        parts.append(_table("Rejected samples", samples(rejected, per_operator)))
        parts.append(_table("Duplicate groups", duplicate_groups(rejected)))
    style = "body{font-family:sans-serif;margin:2em}table{border-collapse:collapse}td,th{border:1px solid #ccc;padding:.3em .6em;text-align:left}.cards{display:flex;gap:1em;flex-wrap:wrap}.cards div{border:1px solid #ccc;border-radius:4px;padding:.6em 1em}.cards b{display:block;font-size:1.4em}svg{font-size:13px}rect{fill:#4477aa}"
    return f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(run_id)}</title><style>{style}</style></head><body><h1>{html.escape(run_id)}</h1>{''.join(parts)}</body></html>"


def write_report(store: MetricsStore, run_id: str | None = None, rejected: DataFrame | None = None, per_operator: int = 20, output: str | None = None, publish: Callable[[str], None] | None = None) -> str:
    """The page's path on the driver; publish, if given, gets that path."""
    body = render(store, run_id, rejected, per_operator)
    path = Path(output or f"{store.path.removeprefix('file://')}/report_{run_id or store.latest()}.html")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body)
    if publish:
        publish(str(path))
    return str(path)
