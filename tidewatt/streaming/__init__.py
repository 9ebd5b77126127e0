"""How new and corrected data reaches existing tables.

The surveyed workload has no unbounded stream: files arrive in batches and late corrections
are covered by a lookback window. This package is that incremental refresh; it deliberately
contains no Structured Streaming job.
"""
