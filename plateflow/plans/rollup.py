"""From finished sub-analyses to the state and files of their analyses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from plateflow.operators.analyses import rollup, rollup_files
from plateflow.operators.files import analysis_results


@dataclass(frozen=True)
class Rollup:
    states: DataFrame
    files: DataFrame
    documents: DataFrame


def plan_rollup(
    analyses: DataFrame, sub_analyses: DataFrame, files: DataFrame, folders: DataFrame
) -> Rollup:
    """New states of the unfinished analyses, and the files of those that have just finished, as rows and as documents."""
    rolled = rollup_files(analyses, sub_analyses, files, folders)
    return Rollup(rollup(analyses, sub_analyses), rolled, analysis_results(rolled))
