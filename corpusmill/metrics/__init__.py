"""Run, stage and operator metrics: tables, roll-ups and a report."""
