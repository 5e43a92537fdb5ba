"""Collects metrics on the driver while code runs."""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime


def new_run_id() -> str:
    return f"run_{datetime.now(UTC):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def nearest_rank(values: list[float], q: float) -> float:
    """The value at place int(n * q) of the sorted values, 0 for none."""
    return sorted(values)[min(len(values) - 1, int(len(values) * q))] if values else 0.0


@dataclass
class Tracked:
    """What a with-block of track_operator fills in."""

    input_records: int = 0
    output_records: int = 0
    errors: int = 0
    latencies: list[float] = field(default_factory=list)
    custom: dict = field(default_factory=dict)

    def batch(self, records_in: int, records_out: int, seconds: float) -> None:
        self.input_records += records_in
        self.output_records += records_out
        if records_in:
            self.latencies += [seconds / records_in] * records_in
            del self.latencies[:-10_000]


class MetricsCollector:
    def __init__(self, run_id: str | None = None):
        self.run_id = run_id or new_run_id()
        self.operators: list[dict] = []
        self.stages: list[dict] = []
        self.runs: list[dict] = []
        self._stage = ""

    @contextmanager
    def track_run(self, config: dict | None = None):
        began, start = datetime.now(UTC), time.monotonic()
        yield self
        took = time.monotonic() - start
        a = self.stages[0]["input_records"] if self.stages else 0
        b = self.stages[-1]["output_records"] if self.stages else 0
        self.runs.append({"run_id": self.run_id, "start_time": began, "end_time": datetime.now(UTC), "duration": took, "num_stages": len(self.stages), "total_input_records": a, "total_output_records": b, "overall_pass_rate": 100.0 * b / a if a else 0.0, "avg_throughput": a / took if took else 0.0, "total_errors": sum(s["error_count"] for s in self.stages), "config": json.dumps(config or {})})

    @contextmanager
    def track_stage(self, name: str):
        before, self._stage = len(self.operators), name
        yield self
        own, self._stage = self.operators[before:], ""
        if own:
            self.stages.append(stage_of(self.run_id, name, own))

    @contextmanager
    def track_operator(self, name: str, worker_id: str = "driver", stage: str | None = None):
        tracked, began, start = Tracked(), datetime.now(UTC), time.monotonic()
        yield tracked
        took = time.monotonic() - start
        n, seen = tracked.input_records, tracked.latencies
        self.add_operator({"run_id": self.run_id, "stage_name": self._stage if stage is None else stage, "operator_name": name, "worker_id": worker_id, "timestamp": began, "input_records": n, "output_records": tracked.output_records, "pass_rate": 100.0 * tracked.output_records / n if n else 0.0, "total_time": took, "avg_latency": took / n if n else 0.0, "min_latency": min(seen, default=0.0), "max_latency": max(seen, default=0.0), "p50_latency": nearest_rank(seen, 0.5), "p95_latency": nearest_rank(seen, 0.95), "p99_latency": nearest_rank(seen, 0.99), "throughput": n / took if took else 0.0, "error_count": tracked.errors, "custom_metrics": json.dumps(tracked.custom)})

    def add_operator(self, row: dict) -> None:
        self.operators.append(row)

    def operators_of(self, stage: str | None = None) -> list[dict]:
        return [r for r in self.operators if stage is None or r["stage_name"] == stage]

    def clear(self) -> None:
        self.operators, self.stages, self.runs = [], [], []


def stage_of(run_id: str, name: str, rows: list[dict]) -> dict:
    """A stage's row from those of its operators and workers: input of the first operator, output of the last."""
    if not rows:
        return {"run_id": run_id, "stage_name": name, "timestamp": datetime.now(UTC), "num_workers": 0, "input_records": 0, "output_records": 0, "pass_rate": 0.0, "total_time": 0.0, "avg_throughput": 0.0, "min_throughput": 0.0, "max_throughput": 0.0, "error_count": 0}
    order = sorted({r["operator_name"]: min(x["timestamp"] for x in rows if x["operator_name"] == r["operator_name"]) for r in rows}.items(), key=lambda x: x[1])
    first, last = order[0][0], order[-1][0]
    a = sum(r["input_records"] for r in rows if r["operator_name"] == first)
    b = sum(r["output_records"] for r in rows if r["operator_name"] == last)
    speeds = [r["throughput"] for r in rows if r["throughput"] > 0]
    return {"run_id": run_id, "stage_name": name, "timestamp": min(r["timestamp"] for r in rows), "num_workers": len({r["worker_id"] for r in rows}), "input_records": a, "output_records": b, "pass_rate": 100.0 * b / a if a else 0.0, "total_time": max(r["total_time"] for r in rows), "avg_throughput": sum(speeds) / len(speeds) if speeds else 0.0, "min_throughput": min(speeds, default=0.0), "max_throughput": max(speeds, default=0.0), "error_count": sum(r["error_count"] for r in rows)}
