"""The registered queries written as SQL for DuckDB."""

from __future__ import annotations

from checks.binding import BRONZE_SQL, BRONZE_TEXT_SQL, COLUMNS

_NAMES = list(COLUMNS)
_RETYPED = {
    "txn_timestamp": "try_strptime(substr(txn_timestamp, 1, 19), '%Y-%m-%d %H:%M:%S')",
    "txn_date": "cast(try_strptime(substr(txn_date, 1, 10), '%Y-%m-%d') as date)",
    "txn_hour": "try_cast(txn_hour as integer)",
}
_FILLED = {
    "failure_reason": "coalesce(failure_reason, 'N/A')",
    "merchant_category": "coalesce(merchant_category, 'UNKNOWN')",
    "merchant_name": "coalesce(merchant_name, 'UNKNOWN')",
}
_FIRST = ", ".join(
    f"{c} asc nulls first"
    for c in ["txn_timestamp", *[c for c in _NAMES if c not in ("txn_id", "txn_timestamp")]]
)


def _select(overrides: dict[str, str]) -> str:
    return ", ".join(f"{overrides[c]} as {c}" if c in overrides else c for c in _NAMES)


def r2(expression: str) -> str:
    """Two decimals, half up on the shortest decimal form of the double."""
    return (
        f"cast(round(cast(cast({expression} as varchar) as decimal(38,12)), 2) as double)"
    )


def _n(condition: str | None = None) -> str:
    return "cast(count(*)" + (f" filter (where {condition})" if condition else "") + " as bigint)"


def _sum(column: str, digits: int = 4) -> str:
    """Exact sum of amounts of a few decimals, as a double."""
    return f"cast(sum(cast({column} as decimal(18,{digits}))) as double)"


_RULES = {
    "amount_positive": "amount > 0",
    "amount_within_limit": "amount <= 1000000",
    "known_status": "status in ('SUCCESS', 'FAILED', 'PENDING')",
    "known_type": "txn_type in ('P2P', 'P2M')",
    "sender_vpa_has_handle": "contains(sender_vpa, '@')",
    "receiver_vpa_has_handle": "contains(receiver_vpa, '@')",
}
_VALID = " and ".join(_RULES.values())

_ENRICHED = """*,
    amount >= 50000 as is_high_value,
    coalesce(txn_hour between 1 and 5, false) as is_odd_hour,
    case when amount < 500 then 'micro' when amount < 5000 then 'small'
         when amount < 50000 then 'medium' else 'large' end as amount_bucket,
    coalesce(sender_bank = receiver_bank, false) as is_same_bank,
    dayname(txn_date) as day_of_week,
    cast(weekofyear(txn_date) as integer) as week_of_year"""

_STAGES = {
    "bronze": BRONZE_SQL,
    "typed": f"select {_select(_RETYPED)} from bronze",
    "complete": f"select {_select(_FILLED)} from typed where txn_id is not null"
    " and txn_timestamp is not null and amount is not null and not isnan(amount)"
    " and status is not null",
    "uniq": "select * from complete qualify row_number() over"
    f" (partition by txn_id order by {_FIRST}) = 1",
    "valid": f"select * from uniq where {_VALID}",
    "silver": f"select {_ENRICHED} from valid",
    "hourly": f"""
        select txn_date, txn_hour, {_n()} as total_txns,
            {_n("status = 'SUCCESS'")} as successful_txns,
            {_n("status = 'FAILED'")} as failed_txns,
            {_n("status = 'PENDING'")} as pending_txns,
            {r2(_sum("amount"))} as total_amount, {r2(f"{_sum('amount')} / count(amount)")} as avg_amount,
            {r2("max(amount)")} as max_amount,
            {r2("count(*) filter (where status = 'SUCCESS') / count(*) * 100")} as success_rate,
            {r2("count(*) filter (where status = 'FAILED') / count(*) * 100")} as failure_rate
        from silver group by txn_date, txn_hour""",
    "banks": f"""
        select sender_bank, {_n()} as total_txns, {_n("status = 'FAILED'")} as failed_txns,
            {r2(_sum("amount"))} as total_amount, {r2(f"{_sum('amount')} / count(amount)")} as avg_amount,
            {r2("count(*) filter (where status = 'FAILED') / count(*) * 100")}
                as failure_rate_pct
        from silver group by sender_bank""",
    "merchants": f"""
        select merchant_category, {_n()} as total_txns, {r2(_sum("amount"))} as total_spend,
            {r2(f"{_sum('amount')} / count(amount)")} as avg_spend, {r2("max(amount)")} as max_spend,
            {_n("status = 'SUCCESS'")} as successful_txns,
            {r2("count(*) filter (where status = 'SUCCESS') / count(*) * 100")} as success_rate
        from silver where txn_type = 'P2M' group by merchant_category""",
    "anomalies": f"""
        select txn_date, sender_bank, {_n()} as anomaly_count,
            {r2(_sum("amount"))} as total_anomaly_amount,
            {r2(f"{_sum('amount')} / count(amount)")} as avg_anomaly_amount, {r2("max(amount)")} as max_anomaly_amount
        from silver where is_anomaly group by txn_date, sender_bank""",
    "flagged": """
        select *, amount >= 150000 as is_spike,
            coalesce(txn_hour between 2 and 4, false) as is_night,
            amount in (100000, 200000, 250000, 500000) as is_round_amount
        from silver""",
    "suspects": "select *, is_spike or is_night or is_round_amount as is_suspect from flagged",
    "bursts": """
        select *, count(*) over (partition by sender_vpa order by epoch(txn_timestamp)
            range between 3600 preceding and current row) as in_window
        from silver""",
    "profile": """
        select sender_bank as b, avg(amount) as m, stddev_samp(amount) as sd
        from silver group by sender_bank""",
    "quartiles": """
        select sender_bank as b, count(*) as n, quantile_cont(amount, 0.25) as q1,
            quantile_cont(amount, 0.75) as q3
        from silver group by sender_bank""",
    "fences": """
        select b, n, q1, q3, q1 - (q3 - q1) * 1.5 as lower_fence,
            q3 + (q3 - q1) * 1.5 as upper_fence
        from quartiles""",
}


def over_stages(query: str) -> str:
    """`query` with every stage available as a table; unused stages cost nothing."""
    ctes = ",\n".join(f"{name} as ({body})" for name, body in _STAGES.items())
    return f"with {ctes}\n{query}"


def _export(stage: str, columns: list[str]) -> str:
    shown = [
        f"cast({c} as varchar) as {c.upper()}" if c == "txn_date" else f"{c} as {c.upper()}"
        for c in columns
    ]
    return f"select {', '.join(shown)} from {stage}"


GOLD_COLUMNS = {
    "hourly": "txn_date txn_hour total_txns successful_txns failed_txns pending_txns"
    " total_amount avg_amount max_amount success_rate failure_rate".split(),
    "banks": "sender_bank total_txns failed_txns total_amount avg_amount"
    " failure_rate_pct".split(),
    "merchants": "merchant_category total_txns total_spend avg_spend max_spend"
    " successful_txns success_rate".split(),
    "anomalies": "txn_date sender_bank anomaly_count total_anomaly_amount"
    " avg_anomaly_amount max_anomaly_amount".split(),
}

_SILVER_NAMES = [
    *_NAMES,
    *"is_high_value is_odd_hour amount_bucket is_same_bank day_of_week week_of_year".split(),
]
_LINEITEM_ORDER = ", ".join(
    f"{c} asc nulls first"
    for c in "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax"
    " l_returnflag l_linestatus".split()
)


def _score(detector: str) -> str:
    tp, fp = f"is_anomaly and {detector}", f"not is_anomaly and {detector}"
    fn, tn = f"is_anomaly and not {detector}", f"not is_anomaly and not {detector}"

    def share(other: str) -> str:
        whole = f"(count(*) filter (where {tp}) + count(*) filter (where {other}))"
        part = f"count(*) filter (where {tp})"
        ratio = f"cast({part} / nullif({whole}, 0) as varchar)"
        return f"cast(round(cast({ratio} as decimal(38,12)), 4) as double)"

    return (
        f"select '{detector}' as detector, {_n(tp)} as tp, {_n(fp)} as fp, {_n(fn)} as fn,"
        f" {_n(tn)} as tn, {share(fp)} as precision, {share(fn)} as recall from suspects"
    )


_KPIS = f"""
    select h.*, a.total_anomalies from
        (select cast(sum(total_txns) as bigint) as total_txns,
            {_sum('total_amount')} as total_volume,
            {_sum('avg_amount')} / count(*) as avg_transaction,
            {_sum('total_amount')} / sum(total_txns) as weighted_avg_amount from hourly) h,
        (select cast(coalesce(sum(anomaly_count), 0) as bigint) as total_anomalies
            from anomalies) a"""

_SILVER = f"select {', '.join(_SILVER_NAMES)} from silver"

_BY_EVENT_HOUR = f"""select cast(w as date) as txn_date, cast(hour(w) as integer) as txn_hour,
            {_n()} as total_txns, {_n("status = 'SUCCESS'")} as successful_txns,
            {_n("status = 'FAILED'")} as failed_txns,
            {_n("status = 'PENDING'")} as pending_txns,
            {r2(_sum("amount"))} as total_amount, {r2(f"{_sum('amount')} / count(amount)")} as avg_amount,
            {r2("max(amount)")} as max_amount,
            {r2("count(*) filter (where status = 'SUCCESS') / count(*) * 100")} as success_rate,
            {r2("count(*) filter (where status = 'FAILED') / count(*) * 100")} as failure_rate
        from (select *, date_trunc('hour', txn_timestamp) as w from silver) as s"""

_CONVERTED = {
    **_RETYPED,
    "amount": "try_cast(amount as double)",
    "is_anomaly": "try_cast(is_anomaly as boolean)",
}
_LOST = {c: f"({c} is not null and {_CONVERTED[c]} is null)" for c in _NAMES if c in _CONVERTED}
_RAW_VALUES = ", ".join(
    f"case when {lost} then '\"{c}\":\"' || {c} || '\"' end" for c, lost in _LOST.items()
)


def over_text(query: str) -> str:
    """`query` over the transactions whose columns are all text."""
    stages = _STAGES | {"bronze": BRONZE_TEXT_SQL, "typed": f"select {_select(_CONVERTED)} from bronze"}
    ctes = ",\n".join(f"{name} as ({body})" for name, body in stages.items())
    return f"with {ctes}\n{query}"


SQL = {
    # Silver, step by step.
    "bronze_scan": over_stages("select * from bronze"),
    "bronze_append": over_stages("select * from bronze"),
    "bronze_append_extras": over_stages(
        """select *, case when txn_date >= '2024-01-16' then 'app-' || device_type end as channel,
            case when txn_date >= '2024-01-16' then amount * 2 end as fee from bronze"""
    ),
    "bronze_mixed_files": over_stages("select * from bronze"),
    "enforce_schema_text": over_text(
        f"""select {_select(_CONVERTED)}, case when {' or '.join(_LOST.values())}
            then '{{' || array_to_string([{_RAW_VALUES}], ',') || '}}' end as raw_values from bronze"""
    ),
    "conversion_audit": over_text(
        " union all ".join(
            f"select '{c}' as column_name, count({c}) as n_values, {_n(_LOST.get(c, 'false'))} as n_lost from bronze"
            for c in _NAMES
        )
    ),
    "silver_text": over_text(_SILVER),
    "enforce_schema": over_stages("select * from typed"),
    "handle_nulls": over_stages("select * from complete"),
    "deduplicate": over_stages("select * from uniq"),
    "validate": over_stages("select * from valid"),
    "enrich": over_stages(_SILVER),
    "silver": over_stages(_SILVER),
    "validation_audit": over_stages(
        f"select {_n()} as input_rows, {_n(_VALID)} as output_rows, "
        + ", ".join(f"{_n(f'not ({rule})')} as failed_{name}" for name, rule in _RULES.items())
        + " from uniq"
    ),
    # Gold.
    "hourly_txn_summary": over_stages("select * from hourly"),
    "bank_failure_analysis": over_stages("select * from banks"),
    "merchant_spend_analysis": over_stages("select * from merchants"),
    "anomaly_summary": over_stages("select * from anomalies"),
    # Gold through the shared rollup.
    "rollup_hourly": over_stages("select * from hourly"),
    "rollup_banks": over_stages("select * from banks"),
    "rollup_merchants": over_stages("select * from merchants"),
    "rollup_anomalies": over_stages("select * from anomalies"),
    # Serving views.
    "hourly_volume": over_stages("select txn_date, txn_hour, total_txns from hourly"),
    "bank_ranking": over_stages("select sender_bank, failure_rate_pct from banks"),
    "merchant_ranking": over_stages("select merchant_category, total_spend from merchants"),
    "anomaly_table": over_stages(
        "select txn_date, sender_bank, anomaly_count, total_anomaly_amount from anomalies"
    ),
    "kpis": over_stages(
        f"select total_txns, total_volume, {r2('avg_transaction')} as avg_transaction,"
        f" {r2('weighted_avg_amount')} as weighted_avg_amount, total_anomalies"
        f" from ({_KPIS})"
    ),
    "kpi_cards": over_stages(
        f"""select unnest(['Total Transactions', 'Total Volume (₹)', 'Avg Transaction (₹)',
                'Total Anomalies']) as label,
            unnest([format('{{:,}}', total_txns), '₹' || format('{{:,.0f}}', total_volume),
                '₹' || format('{{:,.0f}}', avg_transaction),
                format('{{:,}}', total_anomalies)]) as value
        from ({_KPIS})"""
    ),
    # Profile of the raw table.
    "bronze_profile": over_stages(
        f"""select 'rows' as metric, 'all' as item, {_n()} as value from bronze
        union all select 'columns', 'all', {len(_NAMES)}
        union all select 'anomalies', 'all', {_n("is_anomaly")} from bronze
        union all select 'status', status, {_n()} from bronze
            where status is not null group by status"""
    ),
    "status_counts": over_stages(
        f"select status, {_n()} as txns from bronze where status is not null group by status"
    ),
    "anomaly_total": over_stages(f"select {_n('is_anomaly')} as anomalies from bronze"),
    "table_shape": over_stages(
        f"select {_n()} as row_count, cast({len(_NAMES)} as bigint) as column_count,"
        f" '{','.join(_NAMES)}' as column_names from bronze"
    ),
    "first_rows": over_stages(
        "select * from bronze order by txn_id asc nulls first, utr_number, txn_timestamp limit 3"
    ),
    # Storage round trips.
    "silver_roundtrip": over_stages(_SILVER),
    "silver_date_range": over_stages(_SILVER),
    "gold_roundtrip": over_stages("select * from hourly"),
    "gold_roundtrip_banks": over_stages("select * from banks"),
    "gold_roundtrip_merchants": over_stages("select * from merchants"),
    "gold_roundtrip_anomalies": over_stages("select * from anomalies"),
    "gold_range_rerun": over_stages("select * from hourly"),
    "gold_range_rerun_banks": over_stages("select * from banks"),
    "gold_scan": over_stages(
        """select 'HOURLY_TXN_SUMMARY' as table_name, cast(sum(total_txns) as bigint) as txns,
            count(*) as groups from hourly
        union all select 'BANK_FAILURE_ANALYSIS', cast(sum(total_txns) as bigint), count(*)
            from banks
        union all select 'MERCHANT_SPEND_ANALYSIS', cast(sum(total_txns) as bigint), count(*)
            from merchants
        union all select 'ANOMALY_SUMMARY', cast(sum(anomaly_count) as bigint), count(*)
            from anomalies"""
    ),
    "incremental_overwrite": over_stages(
        f"""select {', '.join(c for c in _SILVER_NAMES if c != 'amount')},
            case when txn_date = date '2024-01-10' then amount + 1 else amount end as amount
        from silver"""
    ),
    "pipeline_chain": over_stages("select * from banks"),
    "pipeline_chain_hours": over_stages("select * from hourly"),
    "pipeline_chain_merchants": over_stages("select * from merchants"),
    "pipeline_chain_anomalies": over_stages("select * from anomalies"),
    "pipeline_incremental": over_stages("select * from hourly"),
    "pipeline_incremental_banks": over_stages("select * from banks"),
    "pipeline_incremental_merchants": over_stages("select * from merchants"),
    "pipeline_incremental_anomalies": over_stages("select * from anomalies"),
    # Export.
    "export_hourly": over_stages(_export("hourly", GOLD_COLUMNS["hourly"])),
    "export_banks": over_stages(_export("banks", GOLD_COLUMNS["banks"])),
    "export_merchants": over_stages(_export("merchants", GOLD_COLUMNS["merchants"])),
    "export_anomalies": over_stages(_export("anomalies", GOLD_COLUMNS["anomalies"])),
    "warehouse_export": over_stages(_export("anomalies", GOLD_COLUMNS["anomalies"])),
    "warehouse_views": over_stages(_export("merchants", GOLD_COLUMNS["merchants"])),
    "warehouse_tables": over_stages(_export("banks", GOLD_COLUMNS["banks"])),
    "warehouse_export_hours": over_stages(_export("hourly", GOLD_COLUMNS["hourly"])),
    "warehouse_export_banks": over_stages(_export("banks", GOLD_COLUMNS["banks"])),
    "warehouse_export_merchants": over_stages(_export("merchants", GOLD_COLUMNS["merchants"])),
    "warehouse_hours": over_stages(_export("hourly", GOLD_COLUMNS["hourly"])),
    "warehouse_anomalies": over_stages(_export("anomalies", GOLD_COLUMNS["anomalies"])),
    # Detection.
    "rule_flags": over_stages(
        "select txn_id, is_spike, is_night, is_round_amount, is_suspect from suspects"
    ),
    "velocity_counts": over_stages(
        """select sender_vpa, cast(epoch(txn_timestamp) as bigint) as second,
            count(*) as n, max(in_window) as n_window
        from bursts group by sender_vpa, txn_timestamp"""
    ),
    "velocity": over_stages(
        """select txn_id, sender_vpa, txn_timestamp,
            case when in_window >= 3 then in_window end as window_txns,
            in_window >= 3 as is_velocity
        from bursts"""
    ),
    "zscore": over_stages(
        f"""select txn_id, {r2('(amount - m) / sd')} as z_score,
            abs((amount - m) / sd) > 3 as is_zscore_outlier
        from silver join profile on sender_bank = b"""
    ),
    "zscore_stored_profile": over_stages(
        f"""select txn_id, {r2('(amount - m) / sd')} as z_score,
            abs((amount - m) / sd) > 3 as is_zscore_outlier
        from silver join profile on sender_bank = b"""
    ),
    "zscore_trailing": over_stages(
        f"""select s.txn_id, {r2('(s.amount - h.m) / nullif(h.sd, 0)')} as z_score,
            coalesce(abs((s.amount - h.m) / nullif(h.sd, 0)) > 3, false) as is_zscore_outlier
        from silver s left join (
            select d.sender_bank, d.txn_date, avg(e.amount) as m, stddev_samp(e.amount) as sd
            from (select distinct sender_bank, txn_date from silver) d join silver e
                on d.sender_bank = e.sender_bank
                and e.txn_date between d.txn_date - 7 and d.txn_date - 1
            group by d.sender_bank, d.txn_date) h
            on s.sender_bank = h.sender_bank and s.txn_date = h.txn_date"""
    ),
    "iqr_keeps_columns": over_stages(
        """select txn_id, txn_hour as n, amount as q1,
            amount < lower_fence or amount > upper_fence as is_iqr_outlier
        from (select txn_id, txn_hour, amount, sender_bank from silver) as s
        join fences on sender_bank = b"""
    ),
    "iqr_fences": over_stages(
        f"""select b as sender_bank, n, {r2('q1')} as q1, {r2('q3')} as q3,
            {r2('lower_fence')} as lower_fence, {r2('upper_fence')} as upper_fence
        from fences"""
    ),
    "iqr": over_stages(
        """select txn_id, amount < lower_fence or amount > upper_fence as is_iqr_outlier
        from silver join fences on sender_bank = b"""
    ),
    "confusion": over_stages(
        "select is_anomaly as label, is_suspect as predicted, count(*) as txns"
        " from suspects group by is_anomaly, is_suspect"
    ),
    "detector_score": over_stages(
        " union all ".join(
            _score(d) for d in ("is_spike", "is_night", "is_round_amount", "is_suspect")
        )
    ),
    "failure_alert": over_stages("select * from banks where failure_rate_pct > 10"),
    # The same operators on other tables.
    "lineitem_dedup": f"""select * from lineitem qualify row_number() over
        (partition by l_orderkey, l_linenumber order by {_LINEITEM_ORDER}) = 1""",
    "lineitem_price_quartiles": """
        select l_returnflag, count(*) as n, quantile_cont(l_quantity, 0.25) as q1,
            quantile_cont(l_quantity, 0.5) as q2, quantile_cont(l_quantity, 0.75) as q3
        from lineitem group by l_returnflag""",
    "lineitem_discount_quartiles": """
        select l_linestatus, count(*) as n, round(quantile_cont(l_discount, 0.25), 6) as q1,
            round(quantile_cont(l_discount, 0.5), 6) as q2, round(quantile_cont(l_discount, 0.75), 6) as q3
        from lineitem group by l_linestatus""",
    "orders_rate_summary": f"""
        select o_orderpriority, count(*) as total_orders,
            {_n("o_orderstatus = 'P'")} as partial_orders,
            {r2("cast(sum(cast(o_totalprice as decimal(18,2))) as double)")} as total_amount,
            {r2("cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*)")}
                as avg_amount,
            {r2("count(*) filter (where o_orderstatus = 'P') / count(*) * 100")}
                as partial_rate_pct
        from orders group by o_orderpriority""",
    "orders_velocity": """
        select o_custkey, cast(epoch(o_orderdate) as bigint) as second, count(*) as n,
            max(w) as n_window
        from (select *, count(*) over (partition by o_custkey order by epoch(o_orderdate)
            range between 2592000 preceding and current row) as w from orders) as o
        group by o_custkey, o_orderdate""",
    # Streaming: every row of the clean stream, all hours, and those closed by the watermark.
    "stream_ingest": over_stages(_SILVER),
    "stream_small_steps": over_stages(
        "select * exclude (txn_date, day_of_week, week_of_year)"
        f" from (select {', '.join(_SILVER_NAMES)} from silver) as s"
    ),
    "stream_settle_twice": over_stages(_SILVER),
    "stream_settled_and_live": over_stages(_SILVER),
    "stream_hourly": over_stages(_BY_EVENT_HOUR + " group by w"),
    "stream_hourly_closed": over_stages(
        _BY_EVENT_HOUR
        + """ where w + interval '1' hour <=
            (select max(txn_timestamp) - interval '2' hour from complete)
        group by w"""
    ),
}
