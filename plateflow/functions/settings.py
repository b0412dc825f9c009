"""The typed view of a settings document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateflow import constants as C
from plateflow.functions.json import has_key, json_flag, json_text
from plateflow.schemas import META

# Settings that are numbers, with their types, and those that are lists.
NUMBERS = {"priority": "int", "batch_size": "bigint", "max_errors": "int"}
LISTS = ("site_filter", "well_filter", "channels")


def route(meta: Column) -> Column:
    """Backend of a sub-analysis: `remote`, `cluster`, or `external` for what neither takes.

    The mere presence of a backend key keeps a sub-analysis off the cluster.
    """
    named = has_key(meta, C.BACKEND_KEYS[0])
    for key in C.BACKEND_KEYS[1:]:
        named = named | has_key(meta, key)
    remote = json_flag(meta, C.REMOTE_KEY) & (json_text(meta, "type") == "cellprofiler")
    return F.when(remote, "remote").when(~named, "cluster").otherwise("external")


def classify_type(meta: Column) -> Column:
    """Kind of a sub-analysis; `unknown` for kinds that cannot run."""
    kind = json_text(meta, "type")
    return F.when(kind.isin("cellprofiler", "jupyter_notebook"), kind).otherwise("unknown")


def listed(value: Column) -> Column:
    """The entries of a setting that is a JSON list, or a list of the one value that it is; NULL if it is absent."""
    return F.when(F.trim(value) == "", F.lit(None)).when(
        F.trim(value).startswith("["), F.from_json(value, "array<string>")
    ).otherwise(F.when(value.isNotNull(), F.array(value)))


def _unreadable(field: dict[str, Column]) -> Column:
    """Names of the settings that are given but cannot be read as what they should be."""
    given = lambda name: F.trim(F.coalesce(field[name], F.lit(""))) != ""
    no_number = lambda value, kind: F.trim(value).try_cast(kind).isNull()
    wrong = {name: given(name) & no_number(field[name], kind) for name, kind in NUMBERS.items()}
    for name in LISTS:
        entries = listed(field[name])
        bad = entries.isNull() | F.exists(entries, lambda entry: entry.isNull())
        wrong[name] = given(name) & (bad | F.exists(entries, lambda entry: no_number(entry, "int")) if name == "site_filter" else bad)
    named = [F.when(F.coalesce(condition, F.lit(False)), F.lit(name)) for name, condition in sorted(wrong.items())]
    return F.filter(F.array(*named), lambda name: name.isNotNull())


def with_settings(analyses: DataFrame) -> DataFrame:
    """Add the settings of `meta` as typed columns, with defaults where a key is absent.

    `priority` there is the urgency of the jobs, so it becomes `meta_priority`; the column `priority`
    orders the queue. `unreadable` names the settings that are given but cannot be read, which have their defaults.
    """
    parsed = analyses.withColumn("_meta", F.from_json("meta", META))
    field = {name: F.col(f"_meta.{name}") for name in META.names}
    # Numbers and lists may be given as text, or a single value for a list.
    number = lambda name, kind: F.trim(field[name]).try_cast(kind)
    sites = F.transform(listed(field["site_filter"]), lambda site: F.trim(site).try_cast("int"))
    backend = route(F.col("meta"))
    version = F.when(backend == "remote", C.DEFAULT_VERSION_REMOTE).otherwise(C.DEFAULT_VERSION_CLUSTER)
    return parsed.withColumns(
        {
            "type": classify_type(F.col("meta")),
            "backend": backend,
            "meta_priority": F.coalesce(number("priority", "int"), F.lit(C.DEFAULT_PRIORITY)),
            "is_urgent": F.coalesce(number("priority", "int") == 1, F.lit(False)),
            "site_filter": sites,
            "well_filter": listed(field["well_filter"]),
            "channels": listed(field["channels"]),
            "z": field["z"],
            "cp_version": F.coalesce(field["cp_version"], version),
            "batch_size": F.coalesce(number("batch_size", "bigint"), F.lit(1)),
            "pipeline_file": F.concat(F.lit(f"{C.WORK_ROOT}pipelines/"), field["pipeline_file"]),
            "job_timeout": F.coalesce(field["job_timeout"], F.lit(C.DEFAULT_TIMEOUT)),
            "use_icf": F.coalesce(field["use_icf"], F.lit(False)),
            "sub_type": F.coalesce(field["sub_type"], F.lit(C.DEFAULT_SUB_TYPE)),
            "max_errors": F.coalesce(number("max_errors", "int"), F.lit(C.DEFAULT_MAX_ERRORS)),
            "unreadable": _unreadable(field),
        }
    ).drop("_meta")
