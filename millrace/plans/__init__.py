"""Configured loads."""

from millrace.plans.job import JobConfig, JobResult, run_job

__all__ = ["JobConfig", "JobResult", "run_job"]
