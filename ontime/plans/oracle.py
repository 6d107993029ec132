"""SQL building blocks for the reference results."""

from __future__ import annotations

from ontime.plans.flights import KEY, flights_sql, flights_text_sql
from ontime.schema import CAUSES, CLEAN_NAMES, RENAMES, ZERO_FILLED

DATE = "CAST(FL_DATE AS DATE)"
YEAR = f"CAST(year({DATE}) AS INTEGER)"


def _clean_columns(variant: str) -> dict[str, str]:
    flag = "DOUBLE" if variant == "v1" else "INTEGER"
    columns = {
        "year": YEAR,
        "month": f"CAST(month({DATE}) AS INTEGER)",
        "day_of_week": f"dayname({DATE})",
        "delayed": "CAST(CASE WHEN " + " OR ".join(f"{c} > 0" for c in CAUSES) + f" THEN 1 ELSE 0 END AS {flag})",
        "delayed_time": " + ".join(f"coalesce({c}, 0)" for c in CAUSES),
    }
    for raw, name in RENAMES.items():
        columns[name] = f"coalesce({raw}, 0)" if variant == "v3" and name in ZERO_FILLED else raw
        if name in ("cancelled", "diverted"):
            columns[name] = f"CAST({raw} AS {flag})"
    return columns


def clean_sql(variant: str = "v3") -> str:
    columns = _clean_columns(variant)
    where = "WHERE CRS_DEP_TIME IS NOT NULL" if variant == "v3" else ""
    return f"SELECT {', '.join(KEY)}, FL_DATE, {', '.join(f'{columns[c]} AS {c}' for c in CLEAN_NAMES)} FROM flights {where}"


def on_flights(query: str, **more: str) -> str:
    """The query with ``flights`` in scope, and further named subqueries after it."""
    views = {"flights": f"SELECT *, {YEAR} AS year FROM ({flights_sql(KEY)})"} | more
    return "WITH " + ", ".join(f"{name} AS MATERIALIZED ({body})" for name, body in views.items()) + " " + query


def on_clean(query: str, **more: str) -> str:
    return on_flights(query, clean=clean_sql(), **more)


def on_text(query: str, **more: str) -> str:
    return on_flights(query, text=flights_text_sql(KEY + ["year"]), **more)


def per_column(columns: list[str], template: str) -> str:
    """The template once per column, with {c} replaced, as one UNION ALL."""
    return " UNION ALL ".join(template.replace("{c}", c) for c in columns)
