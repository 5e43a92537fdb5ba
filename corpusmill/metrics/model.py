"""Schemas of the three metric tables."""

OPERATORS = "run_id string, stage_name string, operator_name string, worker_id string, timestamp timestamp, input_records long, output_records long, pass_rate double, total_time double, avg_latency double, min_latency double, max_latency double, p50_latency double, p95_latency double, p99_latency double, throughput double, error_count long, custom_metrics string"
STAGES = "run_id string, stage_name string, timestamp timestamp, num_workers long, input_records long, output_records long, pass_rate double, total_time double, avg_throughput double, min_throughput double, max_throughput double, error_count long"
RUNS = "run_id string, start_time timestamp, end_time timestamp, duration double, num_stages long, total_input_records long, total_output_records long, overall_pass_rate double, avg_throughput double, total_errors long, config string"
TABLES = {"operators": OPERATORS, "stages": STAGES, "runs": RUNS}
