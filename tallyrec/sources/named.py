"""SRC1-SRC3: the job's inputs by logical name, from the catalog, from queries or from the fixtures.

A source map leads from each logical table to one or more catalog tables (one-, two- or three-part names), a
query whose result is the table, or a DataFrame.  Whatever it is, it is read as a DataFrame and laid out as declared:
a missing column is an error before anything runs, other columns are left aside, and types are cast where they
differ.  Several entries (one a channel) are one table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import fixtures as fx
from .io import read_table

LAYOUTS = {
    "alias": "cim_id string, alias_value string, alias_type_id int, first_used_datetime timestamp_ntz, last_used_datetime timestamp_ntz",
    "alias_type": "alias_type_id int, alias_type string",
    "email_engagement": "lower_email_address string, cim_id string, is_employee int, email_click_likelihood string, "
                        "file_name_date date, extract_timestamp timestamp_ntz",
    "subscribers": "email_address string, subscriber_id string, date_created timestamp_ntz, status string",
    "views": "anonymous_id string, post_id string, received_at timestamp_ntz",
    "clicks": "anonymous_id string, post_id string, received_at timestamp_ntz",
    "commission": "anonymous_id string, post_id string, order_count long, commission_date timestamp_ntz",
    "sessions": "anonymous_id string, total_commission double, session_start_at timestamp_ntz",
    "posts": "id long, post_type string, post_status string, post_content string, post_date timestamp_ntz, "
             "post_modified timestamp_ntz, post_name string, post_title string, guid string",
    "post_versions": "id long, post_type string, post_status string, post_content string, post_date timestamp_ntz, "
                     "post_modified timestamp_ntz, post_name string, post_title string, guid string",
    "postmeta": "post_id long, meta_id long, meta_key string, meta_value string",
    "options": "option_name string, option_value string",
    "categories": "post_id long, taxonomy string, slug string, post_date timestamp_ntz",
    "seed_log": "cim_id string, post_id string",
}

Entry = "str | DataFrame | Callable[[], DataFrame] | list"


def laid_out(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the declared columns of the logical table ``name``, in their types."""
    layout = T._parse_datatype_string(LAYOUTS[name])
    have = {c.lower() for c in df.columns}
    missing = [f.name for f in layout if f.name not in have]
    if missing:
        raise ValueError(f"source '{name}' lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    types = {f.name.lower(): f.dataType for f in df.schema}
    return df.select(*(F.col(f.name) if types[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in layout))


@dataclass
class Sources:
    """The inputs of a run and its dates; ``orders_as_of`` is the clock of the session table."""

    spark: SparkSession
    entries: dict
    as_of: dt.datetime
    orders_as_of: dt.datetime

    def _read(self, entry) -> DataFrame:
        if callable(entry):
            return entry()
        if isinstance(entry, str):
            query = entry.lstrip().lower().startswith(("select ", "select\n", "with ", "("))
            return self.spark.sql(entry) if query else read_table(self.spark, entry)
        return entry

    def parts(self, name: str) -> list[DataFrame]:
        if name not in self.entries:
            raise KeyError(f"no source for '{name}'")
        entry = self.entries[name]
        return [laid_out(self._read(e), name) for e in (entry if isinstance(entry, (list, tuple)) else [entry])]

    def table(self, name: str) -> DataFrame:
        first, *rest = self.parts(name)
        for df in rest:
            first = first.unionByName(df)
        return first


def named_sources(spark: SparkSession, entries: dict, as_of: dt.datetime, orders_as_of: dt.datetime | None = None) -> Sources:
    """Sources from catalog names, queries or frames; all logical tables but ``seed_log`` must be there."""
    missing = sorted(set(LAYOUTS) - {"seed_log"} - set(entries))
    unknown = sorted(set(entries) - set(LAYOUTS))
    if missing or unknown:
        raise ValueError(f"sources missing: {missing}; not known: {unknown}")
    return Sources(spark, dict(entries), as_of, orders_as_of or as_of)


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The same tables as views over the test data; the run dates are those of its newest event and order."""
    lazy = {name: (lambda f=getattr(fx, name): f(spark, sf_dir)) for name in LAYOUTS if name not in ("alias_type", "options", "views", "clicks")}
    lazy["alias"] = lambda: materialize(fx.alias(spark, sf_dir))  # derived from all events, read by many steps
    lazy |= {"alias_type": lambda: fx.alias_type(spark), "options": lambda: fx.options(spark)}
    lazy |= {"views": fx.views(spark, sf_dir), "clicks": fx.clicks(spark, sf_dir)}
    return Sources(spark, lazy, fx.as_of(spark, sf_dir), fx.orders_as_of(spark, sf_dir))
