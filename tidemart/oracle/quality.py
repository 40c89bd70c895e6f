"""The checks as SQL, one counting query per declared promise."""

from __future__ import annotations

from datetime import date, datetime

from tidemart.plans import contracts


def _shape(rows: list[str]) -> str:
    body = "\nunion all\n".join(rows)
    return (
        "select table_name, column_name, cast(failures as bigint) as failures,"
        f" case when failures > 0 then 'fail' else 'pass' end as status from (\n{body}\n)"
    )


def _row(table: str, column: str, count: str) -> str:
    return f"select '{table}' as table_name, '{column}' as column_name, ({count}) as failures"


def _source(table: str) -> str:
    return table.replace("raw_", "src_", 1) if table.startswith("raw_") else table


def _repeated(table: str, columns: tuple[str, ...], where: str) -> str:
    key = ", ".join(columns)
    return f"select count(*) from (select {key} from {_source(table)} where {where} group by {key} having count(*) > 1)"


def _outside(column: str, low: int | None, high: int | None) -> str:
    bounds = [f"{column} < {low}"] if low is not None else []
    bounds += [f"{column} > {high}"] if high is not None else []
    return " or ".join(bounds)


def quality_sql(rule_date: date, fresh_at: datetime) -> dict[str, str]:
    quoted = {k: ", ".join(f"'{v}'" for v in vs) for k, vs in contracts.ACCEPTED_VALUES.items()}
    raw_columns = {
        "raw_customers": {"updated_at"}, "raw_email_events": {"event_at"},
        "raw_email_campaigns": {"sent_at"}, "raw_email_profiles": {"created_at"},
        "raw_ad_insights": {"date_day"}, "raw_web_events": {"event_timestamp"},
    }
    fresh = []
    for table, (column, warn, error) in contracts.FRESHNESS.items():
        newest = f"(select max({column}) from {_source(table)})" if column in raw_columns.get(table, ()) else "null"
        fresh.append(
            f"select '{table}' as table_name, '{column}' as column_name,"
            f" date_sub('second', cast({newest} as timestamp), timestamp '{fresh_at}') as age,"
            f" {warn} * 3600 as warn, {error} * 3600 as error"
        )
    return {
        "dq_unique": _shape(
            [
                _row(t, c, _repeated(t, (c,), f"{c} is not null"))
                for t, columns in contracts.UNIQUE.items()
                for c in columns
            ]
        ),
        "dq_not_null": _shape(
            [
                _row(t, c, f"select count(*) - count({c}) from {_source(t)}")
                for t, columns in contracts.NOT_NULL.items()
                for c in columns
            ]
        ),
        "dq_accepted_values": _shape(
            [
                _row(t, c, f"select count(*) from {_source(t)} where {c} not in ({quoted[t, c]})")
                for t, c in contracts.ACCEPTED_VALUES
            ]
        ),
        "dq_relationships": _shape(
            [
                _row(
                    t,
                    c,
                    f"select count(*) from {_source(t)} x where {c} is not null"
                    f" and not exists (select 1 from {_source(p)} y where y.{pc} = x.{c})",
                )
                for (t, c), (p, pc) in contracts.RELATIONSHIPS.items()
            ]
        ),
        "dq_unique_combination": _shape(
            [
                _row(t, ",".join(cs), _repeated(t, cs, "true"))
                for t, cs in contracts.UNIQUE_COMBINATIONS.items()
            ]
        ),
        "dq_between": _shape(
            [
                _row(t, c, f"select count(*) from {_source(t)} where {_outside(c, *bounds)}")
                for (t, c), bounds in contracts.BETWEEN.items()
            ]
        ),
        "dq_freshness": (
            "select table_name, column_name, cast(age as bigint) as age_seconds,"
            " case when age is null or age > error then 'error' when age > warn then 'warn'"
            " else 'pass' end as status from (\n" + "\nunion all\n".join(fresh) + "\n)"
        ),
        "dq_no_future_orders": _shape(
            [
                _row(
                    "fct_orders",
                    "ordered_at",
                    "select count(*) from fct_orders where ordered_at >"
                    f" timestamp '{rule_date} 00:00:00' + interval 1 day",
                )
            ]
        ),
        "dq_positive_revenue": _shape(
            [_row("fct_orders", "order_subtotal", "select count(*) from fct_orders where order_subtotal < 0")]
        ),
        "dq_attribution_coverage": _shape(
            [
                _row(
                    "fct_orders",
                    "utm_source",
                    "select count(*) from fct_orders where (utm_source = '(direct)' or utm_source is null)"
                    " and (source_name = '' or source_name is null)",
                )
            ]
        ),
        "dq_month0_retention": _shape(
            [
                _row(
                    "customer_cohort_retention",
                    "retention_rate",
                    "select count(*) from customer_cohort_retention"
                    " where months_since_acquisition = 0 and retention_rate <> 1.0",
                )
            ]
        ),
    }
