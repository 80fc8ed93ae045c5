"""Sentences about profiles, proposals, mappings and runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of the sentences.
PROFILE_TEXT = "Profiling completed. %d columns analyzed."
PROFILE_DETAIL_TEXT = (
    "Data profiling completed successfully: Analyzed %d columns, Processed %d rows, "
    "Detected %d PII columns, Detected %d PHI columns, File: %s"
)
PROFILE_STORED_TEXT = (
    "Profiling Results: File=%s, Columns=%d, Rows=%d, PII=%d, PHI=%d, Sample=%d"
)
PROPOSAL_TEXT = "DDL generated for %s with %d columns."
MAPPING_TEXT = "Generated %d field mappings with %d DBT models."
RUN_TEXT = "Workflow completed with %d agents executed."


def profile_text(columns: Column) -> Column:
    return F.format_string(PROFILE_TEXT, columns)


def profile_detail_text(
    columns: Column, rows: Column, pii: Column, phi: Column, file: Column
) -> Column:
    return F.format_string(PROFILE_DETAIL_TEXT, columns, rows, pii, phi, file)


def profile_stored_text(
    file: Column, columns: Column, rows: Column, pii: Column, phi: Column, sample: Column
) -> Column:
    return F.format_string(PROFILE_STORED_TEXT, file, columns, rows, pii, phi, sample)


def proposal_text(table: Column, columns: Column) -> Column:
    return F.format_string(PROPOSAL_TEXT, table, columns)


def mapping_text(mappings: Column, models: Column) -> Column:
    return F.format_string(MAPPING_TEXT, mappings, models)


def run_text(agents: Column) -> Column:
    return F.format_string(RUN_TEXT, agents)
