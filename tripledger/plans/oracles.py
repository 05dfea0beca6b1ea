"""The queries of `queries.py` in plain SQL, written separately, for the checking engine."""

from __future__ import annotations

from tripledger.plans import views

_WORDS = {
    "{millis}": "epoch_us(ts) // 1000", "{ts}": '"timestamp"', "{string}": "varchar",
    "{events}": "events", "{payments}": "payments", "{lineitem}": "lineitem", "{lines}": "lines",
    "{orders}": "orders",
}


def _with(text: str, *names: str) -> str:
    """`text` after the common table expressions it names."""
    parts = ", ".join(f"{n} as ({views.filled(_TABLES[n], _WORDS)})" for n in names)
    return f"with {parts} {text}"


_REPORT_COLUMNS = """
       coalesce(b.user_id, g.user_id, p.user_id) as user_id,
       coalesce(b.event_time, g.event_time, p.event_time) as event_ntz,
       b.amount as bank_amount, g.amount as gateway_amount, p.amount as processor_amount,
       b.status as bank_status, g.status as gateway_status, p.status as processor_status,
       b.source as bank_source, g.source as gateway_source, p.source as processor_source,
       if(b.transaction_id is null, 'missing', 'present') as bank_presence,
       if(g.transaction_id is null, 'missing', 'present') as gateway_presence,
       if(p.transaction_id is null, 'missing', 'present') as processor_presence"""

_FULL = "from bank b full join gateway g on b.transaction_id = g.transaction_id"


def _report(second_key: str = "coalesce(b.transaction_id, g.transaction_id)", over: str = "abs({a} - {b}) > 0.01") -> str:
    """Matched rows with checks and verdict; ends in a select over them."""

    def check(a, b):
        return f"if({a}_amount is null or {b}_amount is null, null, if({over.format(a=a + '_amount', b=b + '_amount')}, 'mismatch', 'match'))"

    return f"""
    matched as (select coalesce(b.transaction_id, g.transaction_id, p.transaction_id) as transaction_id, {_REPORT_COLUMNS}
      {_FULL} full join processor p on {second_key} = p.transaction_id),
    checked as (select *, {check('bank', 'gateway')} as bank_gateway_amount_check,
      {check('bank', 'processor')} as bank_processor_amount_check,
      {check('gateway', 'processor')} as gateway_processor_amount_check from matched),
    report as (select *, case
        when 'missing' in (bank_presence, gateway_presence, processor_presence) then 'incomplete'
        when coalesce(bank_gateway_amount_check, '') = 'mismatch' or coalesce(bank_processor_amount_check, '') = 'mismatch'
          or coalesce(gateway_processor_amount_check, '') = 'mismatch' then 'amount_mismatch'
        when coalesce(bank_status <> gateway_status, false) or coalesce(bank_status <> processor_status, false)
          or coalesce(gateway_status <> processor_status, false) then 'status_mismatch'
        else 'reconciled' end as reconciliation_status from checked)"""


_CHANNELS = ("payments", "bank", "gateway", "processor")
_TABLES = {
    "payments": views.PAYMENTS,
    **views.CHANNEL_VIEWS,
    "lines": views.LINE_PAYMENTS,
    "line_bank": views.LINE_CHANNELS["bank"],
    "line_gateway": views.LINE_CHANNELS["gateway"],
    "line_processor": views.LINE_CHANNELS["processor"],
    "order_payments": views.ORDER_PAYMENTS,
    "messages": views.MESSAGES,
}


def _recon(select: str, **options) -> str:
    return f"{_with('', *_CHANNELS).rstrip()}, {_report(**options)} {select}"


def _line_recon(select: str, latest: bool = False) -> str:
    text = "{lines}" if not latest else (
        "(select * exclude rn from (select *, row_number() over (partition by transaction_id order by "
        "event_time desc, amount desc, status desc, source desc, user_id desc) rn from {c}) where rn = 1)"
    )
    sides = {
        c: "({})".format(views.filled(views.LINE_CHANNELS[c], _WORDS)) for c in views.LINE_CHANNELS
    }
    named = ", ".join(
        f"{c} as (select * from {side if not latest else text.replace('{c}', side)})" for c, side in sides.items()
    )
    return f"{_with('', 'lines').rstrip()}, {named}, {_report()} {select}"


# ---------------------------------------------------------------- loading

_RANGE = "\"timestamp\" between epoch_ms(timestamp '2024-01-08') and epoch_ms(timestamp '2024-01-15')"
_LOADED = (
    'transaction_id, user_id, "timestamp", amount, status, source, location, '
    'make_timestamp("timestamp" * 1000) as event_ntz'
)


def _loaded(*names: str) -> str:
    text = " union all ".join(f"select {_LOADED} from {n} where {_RANGE}" for n in names)
    return _with(text, *_CHANNELS)


_CHANNEL_CASE = (
    "case when source = 'bank' then 'bank' "
    "when source in ('Stripe', 'PayPal', 'Adyen', 'Braintree', 'Square') then 'gateway' else 'processor' end"
)

_CONFORMANCE = f"""
, feed as (select *, {_CHANNEL_CASE} as channel from (
    select * from bank union all select * from gateway union all select * from processor))
""" + " union all ".join(
    f"select 'required:{c}' as rule, count(*) as checked, count(*) filter (where \"{c}\" is null) as violations from feed"
    for c in ("transaction_id", "user_id", "timestamp", "amount", "status", "source", "merchant", "card_type")
) + """
 union all select 'domain:status', count(*), count(*) filter (where
    (channel = 'bank' and status not in ('completed', 'pending', 'failed', 'declined'))
    or (channel = 'gateway' and status not in ('completed', 'pending', 'failed', 'error'))
    or (channel = 'processor' and status not in ('completed', 'pending', 'rejected', 'timeout'))) from feed
"""

# ---------------------------------------------------------------- features

_WEEK = "extract(week from event_time)"


def _volume(source: str, grain: str = "clock") -> str:
    slots = {
        "clock": {"hourly": "extract(hour from event_time)", "daily": "cast(event_time as date)", "weekly": _WEEK},
        "bucket": {p: f"date_trunc('{u}', event_time)" for p, u in (("hourly", "hour"), ("daily", "day"), ("weekly", "week"))},
    }[grain]
    parts = [
        f"{p} as (select user_id, max(n) as max_txn_count_{p}, cast(max(total) as double) as max_txn_amount_{p} from "
        f"(select user_id, {slot} as slot, count(transaction_id) as n, sum(cast(amount as decimal(18,2))) as total "
        f"from {source} group by 1, 2) group by 1)"
        for p, slot in slots.items()
    ]
    return ", ".join(parts) + """, volume as (select h.user_id, max_txn_count_hourly, max_txn_count_daily,
        max_txn_count_weekly, max_txn_amount_hourly, max_txn_amount_daily, max_txn_amount_weekly
        from hourly h join daily d on h.user_id = d.user_id join weekly w on h.user_id = w.user_id)"""


_CENTS = "cast(cast(amount as decimal(18,2)) * 100 as bigint)"
_FAILED = "status in ('failed', 'declined', 'rejected', 'error', 'timeout')"
_STATS = f"""stats as (select user_id, count(amount) as n, sum({_CENTS}) as s, sum(cast({_CENTS} as hugeint) * {_CENTS}) as q,
    max(amount) as max_txn_amount, min(amount) as min_txn_amount,
    count(distinct location) as location_count, count(distinct device_id) as device_count,
    count(distinct ip_address) as ip_count, count(distinct card_type) as card_type_count,
    count(*) filter (where {_FAILED}) as failed_txn_count, count(transaction_id) as n_txn
    from payments group by user_id)"""
_AVG = "(cast(s as double) / 100) / cast(n as double) as avg_txn_amount"
_SD = (
    "if(n > 1, sqrt((cast(n * q - s * s as double) / 10000) / (cast(n as double) * (cast(n as double) - 1))), null) "
    "as stddev_txn_amount"
)
_RATIO = "if(n_txn = 0, null, cast(failed_txn_count as double) / n_txn) as failed_txn_ratio"
_SCORE = (
    "max_txn_count_hourly * 0.5::double + location_count * 0.1::double + device_count * 0.1::double "
    "+ ip_count * 0.1::double + failed_txn_ratio * 5.0::double as risk_score"
)
_FEATURES = f"""{{volume}}, {_STATS}, profile as (select *, {_AVG}, {_SD}, {_RATIO} from stats),
    features as (select v.*, avg_txn_amount, stddev_txn_amount, max_txn_amount, min_txn_amount, location_count,
      device_count, ip_count, card_type_count, failed_txn_count, failed_txn_ratio, {_SCORE}
      from volume v join profile p on v.user_id = p.user_id)"""


def _features(select: str) -> str:
    return f"{_with('', 'payments').rstrip()}, {_FEATURES.replace('{volume}', _volume('payments'))} {select}"


def _stats(select: str) -> str:
    return f"{_with('', 'payments').rstrip()}, {_STATS} {select} from stats"


def _over(keys: str) -> str:
    return f"over (partition by user_id, {keys})"


_WINDOWED = f"""select transaction_id, user_id, amount, event_time as event_ntz,
    count(transaction_id) {_over('hour(event_time)')} as txn_count_hourly,
    count(transaction_id) {_over('cast(event_time as date)')} as txn_count_daily,
    count(transaction_id) {_over(_WEEK)} as txn_count_weekly,
    cast(sum(cast(amount as decimal(18,2))) {_over('hour(event_time)')} as double) as txn_amount_hourly,
    cast(sum(cast(amount as decimal(18,2))) {_over('cast(event_time as date)')} as double) as txn_amount_daily,
    cast(sum(cast(amount as decimal(18,2))) {_over(_WEEK)} as double) as txn_amount_weekly,
    avg_txn_amount, stddev_txn_amount, max_txn_amount, min_txn_amount, location_count, device_count, ip_count,
    card_type_count, failed_txn_count, failed_txn_ratio
    from payments join profile using (user_id)"""

# ---------------------------------------------------------------- rules

_RUN = "over (partition by user_id order by event_time, transaction_id rows between unbounded preceding and current row)"
_RULES = f"""running as (select transaction_id, user_id, amount, status, event_time, count(*) {_RUN} as txn_count,
    cast(sum(cast(amount as decimal(18,2))) {_RUN} as double) as txn_total from {{source}}),
  flagged as (select *, amount > 200 as is_large, txn_count >= 2 and txn_total > 300 as is_repeated,
    status in ('failed', 'declined') as is_bad_status from running),
  judged as (select *, is_large or is_repeated or is_bad_status as is_suspicious,
    if(is_large or is_repeated or is_bad_status, 'alert', 'normal') as row_class from flagged)"""
_RULE_COLUMNS = (
    "transaction_id, user_id, amount, status, txn_count, txn_total, is_large, is_repeated, is_bad_status, "
    "is_suspicious, row_class"
)
_LARGE = "'Large transaction of ' || cast(amount as varchar) || ' exceeds threshold of 200.0'"
_REPEAT = "'Multiple transactions totaling ' || printf('%.2f', txn_total) || ' from user ' || user_id"
_STATUS = "'Transaction has suspicious status: ' || status"


def _reasons(status: bool = True) -> str:
    last = f", if(is_bad_status, {_STATUS}, null)" if status else ""
    return f"concat_ws(' & ', if(is_large, {_LARGE}, null), if(is_repeated, {_REPEAT}, null){last})"


def _line(status: bool = True) -> str:
    return (
        f"if(is_suspicious, 'FRAUD ALERT: ' || user_id || ' - ' || printf('%.2f', amount) || ' - ' || {_reasons(status)}, "
        "'NORMAL: ' || user_id || ' - ' || printf('%.2f', amount))"
    )


def _rules(select: str, source: str = "payments") -> str:
    return f"{_with('', 'payments').rstrip()}, {_RULES.replace('{source}', source)} {select} from judged"


def _fine_rules() -> str:
    """The rules over a seventh of each amount, rounded to four places."""
    fine = "fine as (select * replace (cast(round(amount / 7, 4) as double) as amount) from payments)"
    rules = _RULES.replace("{source}", "fine").replace("decimal(18,2)", "decimal(18,4)")
    return f"{_with('', 'payments').rstrip()}, {fine}, {rules} select {_RULE_COLUMNS} from judged"


_SHAPE = """case when event_type = 'click' then 'text'
    when event_type = 'error' and amount < 10 then 'invalid'
    when event_type = 'error' and amount >= 40 and amount < 50 then 'error' else 'json' end"""
_CLASS = """case when event_type = 'error' and amount < 10 then 'invalid'
    when event_type = 'error' and amount < 30 then 'missing'
    when event_type = 'error' and amount < 50 then 'error'
    when event_type = 'error' and amount < 60 then 'missing' else 'valid' end"""
_PARSED_USER = """case when event_type = 'error' and amount < 10 then null
    when event_type = 'error' and amount < 20 then ''
    when event_type = 'error' and amount >= 40 and amount < 60 then null else user_id end"""
_PARSED_AMOUNT = """case when event_type = 'error' and amount < 10 then null
    when event_type = 'error' and amount >= 20 and amount < 50 then null else amount end"""
_PARSED_STATUS = """case when event_type = 'error' and (amount < 10 or (amount >= 40 and amount < 50)) then null
    when event_type in ('click', 'view') or (event_type = 'error' and amount < 60) then 'unknown' else status end"""

_BURST = """select transaction_id, user_id, burst_count, burst_count >= 5 as is_burst from (
    select transaction_id, user_id, count(*) over (partition by user_id order by event_time
      range between interval 1 day preceding and current row) as burst_count from payments)"""


def _field(name: str, value: str, text: bool = True) -> str:
    quote = '"' if text else ""
    return f"""if({value} is null, '', ',"{name}":{quote}' || cast({value} as varchar) || '{quote}')"""


_RESULT_JSON = "'{\"transaction_id\":\"' || transaction_id || '\"' || " + " || ".join(
    [
        _field("user_id", "user_id"),
        _field("reconciliation_status", "reconciliation_status"),
        *[_field(f"{c}_presence", f"{c}_presence") for c in _CHANNELS[1:]],
        *[_field(f"{c}_amount", f"{c}_amount", text=False) for c in _CHANNELS[1:]],
        *[_field(f"{c}_status", f"{c}_status") for c in _CHANNELS[1:]],
    ]
) + " || '}'"

_ALERT_JSON = "'{\"transaction_id\":\"' || transaction_id || '\"' || " + " || ".join(
    [
        _field("user_id", "user_id"),
        *[_field(n, n, text=n == "status") for n in ("amount", "status", "txn_count", "txn_total")],
        *[_field(n, n, text=False) for n in ("is_large", "is_repeated", "is_bad_status")],
    ]
) + f""" || ',"reasons":["' || replace({_reasons()}, ' & ', '","') || '"]}}'"""

_PCT = ", ".join(
    f"if(total_count > 0, cast(({v}_count * 20000 + total_count) // (total_count * 2) as double) / 100, null) as {v}_pct"
    for v in ("incomplete", "amount_mismatch", "status_mismatch", "reconciled")
)
_SUMMARY = "select *, " + _PCT + " from (select count(*) as total_count, " + ", ".join(
    f"count(*) filter (where reconciliation_status = '{v}') as {v}_count"
    for v in ("incomplete", "amount_mismatch", "status_mismatch", "reconciled")
) + " from report)"

_REPORT = "select * from report"


def _upserted_features() -> str:
    """All payments' features, replaced for users with a large payment."""

    def run(prefix: str, source: str, at: str) -> str:
        return f"""{prefix}_v as (select user_id, max(n) as max_txn_count_hourly from (select user_id, hour(event_time),
              count(transaction_id) as n from {source} group by 1, 2) group by 1),
            {prefix}_s as (select user_id, count(amount) as n, sum({_CENTS}) as s,
              count(distinct location) as location_count, count(distinct device_id) as device_count,
              count(distinct ip_address) as ip_count, count(*) filter (where {_FAILED}) as failed_txn_count,
              count(transaction_id) as n_txn from {source} group by 1),
            {prefix} as (select user_id, max_txn_count_hourly, {_AVG}, {_SCORE}, timestamp '{at}' as extracted_at from (
              select v.user_id, v.max_txn_count_hourly, s.*  exclude (user_id), {_RATIO}
              from {prefix}_v v join {prefix}_s s on v.user_id = s.user_id))"""

    return (
        f"{_with('', 'payments').rstrip()}, large as (select * from payments where amount > 250), "
        f"{run('first', 'payments', '2024-02-01')}, {run('second', 'large', '2024-02-02')} "
        "select * from second union all select * from first where user_id not in (select user_id from second)"
    )


def _upserted_bank_key_report() -> str:
    sides = ", gateway as (select * from g1 union all select * from g1 where amount > 400), " \
        "processor as (select * replace (if(amount > 50, transaction_id, null) as transaction_id) from p1)"
    tables = _with("", *_CHANNELS).rstrip().replace("gateway as (", "g1 as (").replace("processor as (", "p1 as (")
    columns = "transaction_id, user_id, bank_presence, gateway_presence, processor_presence, reconciliation_status"
    report = _report(second_key="b.transaction_id")
    early = f"{tables}{sides}, {report} select {columns}, timestamp '2024-02-01' as reconciled_at from report"
    late = early.replace("full join processor p", "full join bank p").replace("02-01", "02-02") + " where bank_presence = 'present'"
    return (
        f"select * from ({late}) union all select * from ({early}) "
        f"where transaction_id is null or transaction_id not in (select transaction_id from ({late}))"
    )


def _upserted_report() -> str:
    early = _recon("select transaction_id, user_id, reconciliation_status, timestamp '2024-02-01' as reconciled_at from report")
    late = _recon(
        "select transaction_id, user_id, reconciliation_status, timestamp '2024-02-02' as reconciled_at from report "
        "where bank_presence = 'present'"
    ).replace("full join processor p", "full join bank p")
    return (
        f"select * from ({late}) union all select * from ({early}) "
        f"where transaction_id not in (select transaction_id from ({late}))"
    )


_STREAM_BURST = """
, windows as (select user_id, time_bucket(interval 6 hour, event_time) - k * interval 6 hour as starts_at
    from payments, (select unnest([0, 1, 2, 3]) as k))
select user_id, starts_at, starts_at + interval 24 hour as ends_at, count(*) as txn_count from windows
group by user_id, starts_at
having count(*) >= 5
   and starts_at + interval 24 hour <= (select date_trunc('millisecond', max(event_time)) - interval 1 minute from payments)
"""

ORACLES = {
    "load_topic": _loaded("bank"),
    "load_topic_lookback": _loaded("gateway"),
    "load_topics_union": _loaded("bank", "gateway", "processor"),
    "load_missing_topic": _loaded("bank", "gateway"),
    "load_json_array": _loaded("bank"),
    "load_counts": _with(
        " union all ".join(
            f"select '{c}_transactions' as name, count(*) as row_count from {c} where {_RANGE}" for c in _CHANNELS[1:]
        ),
        *_CHANNELS,
    ),
    "channel_split": _with(f"select transaction_id, source, {_CHANNEL_CASE} as channel from payments", "payments"),
    "schema_conformance": _with("", *_CHANNELS).rstrip() + _CONFORMANCE,
    "recon_detail": _recon(_REPORT),
    "recon_detail_bank_key": _recon(_REPORT, second_key="b.transaction_id"),
    "recon_detail_exact": _recon(
        _REPORT, over="abs(cast({a} as decimal(18,2)) - cast({b} as decimal(18,2))) > cast(1.5 as decimal(18,2))"
    ),
    "recon_two_way": _with(
        f"""select coalesce(b.transaction_id, g.transaction_id) as transaction_id, coalesce(b.user_id, g.user_id) as user_id,
        b.amount as bank_amount, g.amount as gateway_amount, b.status as bank_status, g.status as gateway_status,
        if(b.transaction_id is null, 'missing', 'present') as bank_presence,
        if(g.transaction_id is null, 'missing', 'present') as gateway_presence,
        if(b.amount is null or g.amount is null, null, if(abs(b.amount - g.amount) > 0.01, 'mismatch', 'match'))
          as bank_gateway_amount_check,
        case when b.transaction_id is null or g.transaction_id is null then 'incomplete'
          when abs(b.amount - g.amount) > 0.01 then 'amount_mismatch'
          when b.status <> g.status then 'status_mismatch' else 'reconciled' end as reconciliation_status {_FULL}""",
        *_CHANNELS,
    ),
    "recon_amount_checks": _recon(
        "select bank_gateway_amount_check, bank_processor_amount_check, gateway_processor_amount_check, "
        "count(*) as txn_count from report group by 1, 2, 3"
    ),
    "recon_status_checks": _recon(
        "select bank_status, gateway_status, processor_status, reconciliation_status, count(*) as txn_count "
        "from report group by 1, 2, 3, 4"
    ),
    "recon_summary": _recon(_SUMMARY),
    "recon_result_payload": _recon(
        f"select 'reconciliation_results' as topic, transaction_id as key, {_RESULT_JSON} as value from report "
        "where reconciliation_status <> 'reconciled'"
    ),
    "recon_duplicates": _line_recon(_REPORT),
    "recon_hot_ids": _line_recon(_REPORT),
    "recon_latest": _line_recon(_REPORT, latest=True),
    "user_features": _features("select * from features"),
    "user_features_volume": f"{_with('', 'payments').rstrip()}, {_volume('payments')} select * from volume",
    "user_features_volume_bucketed": f"{_with('', 'payments').rstrip()}, {_volume('payments', 'bucket')} select * from volume",
    "user_features_week_collision": f"{_with('', 'order_payments').rstrip()}, {_volume('order_payments')} select * from volume",
    "user_features_amount": _stats(f"select user_id, {_AVG}, {_SD}, max_txn_amount, min_txn_amount"),
    "user_features_diversity": _stats("select user_id, location_count, device_count, ip_count, card_type_count"),
    "user_features_failed": _stats(f"select user_id, failed_txn_count, {_RATIO}"),
    "user_features_windowed": (
        f"{_with('', 'payments').rstrip()}, {_STATS}, profile as (select *, {_AVG}, {_SD}, {_RATIO} from stats) {_WINDOWED}"
    ),
    "risk_score": _features("select user_id, risk_score from features"),
    "high_risk_users": _features("select user_id, risk_score from features where risk_score > 5"),
    "feature_summary": _features(
        "select *, if(user_count > 0, cast((high_risk_count * 20000 + user_count) // (user_count * 2) as double) / 100, null) "
        "as high_risk_pct from (select count(*) as user_count, count(*) filter (where risk_score > 5) as high_risk_count "
        "from features)"
    ),
    "txn_parse": _with(
        f"select transaction_id as sent_id, {_SHAPE} as shape, {_PARSED_USER} as user_id, {_PARSED_AMOUNT} as amount, "
        f"{_PARSED_STATUS} as status from payments",
        "payments",
    ),
    "txn_validate": _with(f"select transaction_id as sent_id, {_CLASS} as row_class from payments", "payments"),
    "fraud_rules": _rules(f"select {_RULE_COLUMNS}"),
    "fraud_rules_fine_amounts": _fine_rules(),
    "fraud_rules_hot_users": _rules(f"select {_RULE_COLUMNS}"),
    "fraud_alert_text": _rules(f"select transaction_id, {_line()} as verdict"),
    "fraud_text_sample": (
        f"{_with('', 'payments').rstrip()}, plain as (select * replace ('unknown' as status) from payments), "
        f"{_RULES.replace('{source}', 'plain')} select transaction_id as sent_id, {_line(status=False)} as verdict from judged"
    ),
    "fraud_alert_payload": _rules(
        f"select 'fraud_alerts' as topic, transaction_id as key, {_ALERT_JSON} as value"
    ) + " where is_suspicious",
    "burst_detect": _with(_BURST, "payments"),
    "burst_detect_hot_users": _with(_BURST, "payments"),
    "dedupe_latest": """select * exclude rn from (select *, row_number() over (partition by l_orderkey, l_linenumber
        order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc,
        l_tax desc, l_returnflag desc, l_linestatus desc) as rn from lineitem) where rn = 1""",
    "upsert_features": _upserted_features(),
    "upsert_reconciled": _upserted_report(),
    "upsert_reconciled_bank_key": _upserted_bank_key_report(),
    "upsert_indexed": _with(
        """select transaction_id, user_id, amount, if(amount > 400, 'settled', status) as status,
        cast(event_time as date) + if(amount > 400, 3, 0) as event_date,
        if(amount > 400, timestamp '2024-02-02', timestamp '2024-02-01') as stored_at from payments
        union all select transaction_id || '-2', user_id, amount, status, cast(event_time as date),
        timestamp '2024-02-02' from payments where amount < 5""",
        "payments",
    ),
    "upsert_snapshot": _with(
        """select version, status, count(*) as txn_count, count(distinct transaction_id) as ids,
        cast(sum(cast(amount as decimal(18,2))) as double) as amount from (
        select 1 as version, transaction_id, status, amount from payments
        union all select 2, transaction_id, if(amount > 400, 'quick', status), amount from payments
        union all select v, transaction_id, if(amount > 300, 'slow', status), amount from payments, (values (3), (4)) as w(v)
        union all select 4, transaction_id || '-2', status, amount from payments where amount < 5)
        group by version, status""",
        "payments",
    ),
    "stream_source": _with(
        f"select 'bank_transactions' as topic, {_SHAPE} as shape, {_CLASS} as row_class, {_PARSED_USER} as user_id, "
        f"{_PARSED_AMOUNT} as amount from payments",
        "payments",
    ),
    "stream_union": _with(
        " union all ".join(
            f"select '{c}_transactions' as topic, transaction_id, user_id, amount, status from {c}" for c in _CHANNELS[1:]
        ),
        *_CHANNELS,
    ),
    "land_topics": _loaded("bank", "gateway", "processor"),
    "stream_fraud_rules": _rules(f"select {_RULE_COLUMNS}"),
    "stream_burst": _with("", "payments").rstrip() + _STREAM_BURST,
    "stream_restart": _rules(f"select {_RULE_COLUMNS}"),
    "stream_fraud_ledger": _rules(f"select {_RULE_COLUMNS}"),
}

def _drift() -> str:
    """Counted from the payments' columns, without a look into any message."""
    fine = "not (event_type = 'error' and amount < 200)"
    always = [("transaction_id", "known", "'string'"), ("user_id", "known", "'string'"), ("timestamp", "known", "'integer'"),
              ("source", "known", "'string'"), ("merchant", "known", "'string'")]
    cases = [(f, k, t, fine) for f, k, t in always] + [
        ("amount", "retyped", "'string'", "event_type = 'view'"), ("amount", "empty", "'null'", "event_type = 'click'"),
        ("amount", "known", "'number'", f"event_type not in ('view', 'click') and {fine}"),
        ("status", "absent", "null", "event_type = 'signup'"), ("status", "known", "'string'", f"event_type <> 'signup' and {fine}"),
        ("card_type", "retyped", "'object'", f"event_type = 'error' and {fine}"), ("card_type", "known", "'string'", "event_type <> 'error'"),
        ("location", "known", "'null'", f"amount < 50 and {fine}"), ("location", "known", "'string'", f"amount >= 50 and {fine}"),
        ("channel", "unknown", "'array'", "event_type = 'purchase'"), ("retry", "unknown", "'boolean'", "event_type = 'purchase'"),
        (None, "unreadable", "null", f"not ({fine})")]
    rows = " union all ".join(
        f"select topic, event_date, {repr(f) if f else 'null'} as field, '{k}' as kind, {t} as type, count(*) as messages "
        f"from sent where {where} group by topic, event_date" for f, k, t, where in cases)
    return f"""{_with('', 'payments').rstrip()}, sent as (
        select concat(case when amount < 100 then 'bank' else 'gateway' end, '_transactions') as topic,
        cast(event_time as date) as event_date, amount, event_type from payments),
        total as (select topic, event_date, count(*) as n from sent group by all), found as ({rows})
        select found.*, round(messages / n, 9) as share from found join total using (topic, event_date)"""


def _verdict_lines() -> str:
    rejected = "case class when 'invalid' then 'Invalid transaction format: ' when 'missing' then " \
        "'Missing required fields in transaction: ' else 'Error processing: ' end || value"
    return f"""{_with('', 'payments', 'messages').rstrip()},
        plain as (select * replace ({_PARSED_STATUS} as status) from payments where {_CLASS} = 'valid'),
        {_RULES.replace('{source}', 'plain')} select {_line()} as value from judged
        union all select {rejected} from (select value, {_CLASS} as class from messages) where class <> 'valid'"""


ORACLES |= {"schema_drift": _drift(), "stream_verdict_lines": _verdict_lines()}

# Other ways to the same rows.
ORACLES |= {
    "user_features_incremental": ORACLES["user_features"],
    "stream_fraud_rules_ordered": ORACLES["fraud_rules"],
    "stream_burst_exact": ORACLES["burst_detect"],
    "stream_reconcile": ORACLES["recon_detail"],
    "recon_bucketed": ORACLES["recon_detail"],
    "stream_alert_outbox": ORACLES["fraud_alert_payload"],
}
