"""Sinks and result encodings."""

from .encode import array_lines, console_lines, json_document, json_lines, parallel_arrays
from .write import DEFAULT_JOBS, Job, current, finished_jobs, replaced, run_jobs, write_json, write_json_array, write_text

__all__ = ["DEFAULT_JOBS", "Job", "array_lines", "console_lines", "current", "finished_jobs", "json_document", "json_lines", "parallel_arrays",
           "replaced", "run_jobs", "write_json", "write_json_array", "write_text"]
