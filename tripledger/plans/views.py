"""Payment records over the driver's tables.

The tables hold no payments, so `events` is read as payments, one for one. Each channel
reports the same payment with its own gaps, amounts and statuses, decided by the payment's
type and value. The SQL text runs unchanged in Spark and in the checking engine, except for
the expression that turns a timestamp into epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripledger.settings import apply_session_conf

PAYMENTS = """
select concat('txn-', cast(event_id as varchar(20))) as transaction_id,
       concat('user_', cast(user_id as varchar(20))) as user_id,
       {millis} as {ts},
       value as amount,
       case event_type when 'purchase' then 'completed' when 'view' then 'completed'
            when 'click' then 'pending' when 'error' then 'failed' else 'declined' end as status,
       case event_type when 'view' then 'bank' when 'click' then 'Stripe' when 'purchase' then 'Square'
            when 'error' then 'TSYS' else 'Elavon' end as source,
       concat('shop_', event_type) as merchant,
       case when value < 20 then 'visa' when value < 60 then 'mastercard'
            when value < 120 then 'amex' else 'discover' end as card_type,
       case when event_type = 'error' then null
            else concat('city_', cast(day(ts) as varchar(20))) end as location,
       concat('10.0.', cast(hour(ts) as varchar(20)), '.', regexp_extract(props, '([0-9]+)', 1)) as ip_address,
       concat('device_', regexp_extract(props, '([0-9]+)', 1)) as device_id,
       ts as event_time, event_type
from {events}
"""

BANK = """
select transaction_id, user_id, {ts}, amount, status, 'bank' as source, merchant, card_type,
       location, ip_address, device_id, event_time
from {payments} where not (event_type = 'view' and amount > 100)
"""

GATEWAY = """
select transaction_id, user_id, {ts},
       case when event_type = 'purchase' and amount < 20 then amount + 1.5 else amount end as amount,
       status, case when card_type = 'visa' then 'Stripe' else 'Adyen' end as source, merchant, card_type,
       location, ip_address, device_id, event_time
from {payments} where not (event_type = 'click' and amount > 80)
"""

PROCESSOR = """
select transaction_id, user_id, {ts}, amount,
       case when event_type = 'error' and amount < 30 then 'timeout' else status end as status,
       case when card_type = 'amex' then 'TSYS' else 'Fiserv' end as source, merchant, card_type,
       location, ip_address, device_id, event_time
from {payments} where not (event_type = 'signup' and amount > 60)
"""

CHANNEL_VIEWS = {"bank": BANK, "gateway": GATEWAY, "processor": PROCESSOR}

# Line items as payments: order and line number do not identify them, so ids repeat.
LINE_PAYMENTS = """
select concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20))) as transaction_id,
       concat('supplier_', cast(l_suppkey as varchar(20))) as user_id,
       l_shipdate as event_time, l_extendedprice as amount, l_returnflag as status,
       l_linestatus as source
from {lineitem}
"""
LINE_CHANNELS = {
    "bank": "select * from {lines}",
    "gateway": "select * from {lines} where source = 'O'",
    "processor": "select * from {lines} where status <> 'R'",
}

# Orders as payments: they span several years.
ORDER_PAYMENTS = """
select concat('order-', cast(o_orderkey as varchar(20))) as transaction_id,
       concat('customer_', cast(o_custkey as varchar(20))) as user_id,
       o_orderdate as event_time, o_totalprice as amount, o_orderstatus as status
from {orders}
"""

# Payments as the raw messages of a topic: objects, amounts as text, plain text, and
# messages that break a rule.
MESSAGES = """
select transaction_id, user_id, amount, event_type, status,
       case when event_type = 'click' then
              concat('Transaction: ', user_id, ', amount=', cast(amount as {string}))
            when event_type = 'view' then
              concat('{"transaction_id":"', transaction_id, '","user_id":"', user_id, '","timestamp":',
                     cast({ts} as {string}), ',"amount":"', cast(amount as {string}), '"}')
            when event_type = 'error' and amount < 10 then concat('{"user_id":"', user_id)
            when event_type = 'error' and amount < 20 then concat('{"user_id":"","amount":', cast(amount as {string}), '}')
            when event_type = 'error' and amount < 30 then concat('{"user_id":"', user_id, '","amount":null}')
            when event_type = 'error' and amount < 40 then concat('{"user_id":"', user_id, '","amount":"abc"}')
            when event_type = 'error' and amount < 50 then concat('[', cast(amount as {string}), ']')
            when event_type = 'error' and amount < 60 then concat('{"amount":', cast(amount as {string}), '}')
            else concat('{"transaction_id":"', transaction_id, '","user_id":"', user_id, '","timestamp":',
                     cast({ts} as {string}), ',"amount":', cast(amount as {string}),
                     ',"status":"', status, '"}') end as value
from {payments}
"""

# Payments as messages that drift from the contract, each in its way by type and amount.
DRIFTING = """
select concat(case when amount < 100 then 'bank' else 'gateway' end, '_transactions') as topic,
       cast(event_time as date) as event_date, amount, event_type,
       case when event_type = 'error' and amount < 200 then concat('broken {', user_id)
            else concat('{"transaction_id":"', transaction_id, '","user_id":"', user_id, '","timestamp":', cast({ts} as {string}),
              case when event_type = 'view' then concat(',"amount":"', cast(amount as {string}), '"')
                   when event_type = 'click' then ',"amount":null' else ',"amount":12.5' end,
              case when event_type = 'signup' then '' else ',"status":"completed"' end,
              ',"source":"bank","merchant":"m","card_type":',
              case when event_type = 'error' then '{"brand":"visa"}' else '"visa"' end,
              ',"location":', case when amount < 50 then 'null' else '"here"' end,
              case when event_type = 'purchase' then ',"channel":["web",7],"retry":true' else '' end, '}') end as value
from {payments}
"""

# What differs between the two engines.
SPARK_WORDS = {
    "{millis}": "unix_millis(cast(ts as timestamp))", "{ts}": "`timestamp`", "{string}": "string"
}


def filled(text: str, words: dict[str, str]) -> str:
    for mark, word in words.items():
        text = text.replace(mark, word)
    return text


def _view(spark: SparkSession, text: str, name: str, frame: DataFrame) -> DataFrame:
    """The text over `frame`, which the text calls `{name}`. JSON braces in the text rule
    out formatted SQL, hence the temporary view."""
    view = f"tripledger_{name}"
    frame.createOrReplaceTempView(view)
    return spark.sql(filled(text, {**SPARK_WORDS, f"{{{name}}}": view}))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_session_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_of(table(spark, sf_dir, "events"))


def payments_of(events: DataFrame) -> DataFrame:
    return _view(events.sparkSession, PAYMENTS, "events", events)


def channels(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    source = payments(spark, sf_dir)
    return {c: _view(spark, text, "payments", source) for c, text in CHANNEL_VIEWS.items()}


def line_channels(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lines = _view(spark, LINE_PAYMENTS, "lineitem", table(spark, sf_dir, "lineitem"))
    return {c: _view(spark, text, "lines", lines) for c, text in LINE_CHANNELS.items()}


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, ORDER_PAYMENTS, "orders", table(spark, sf_dir, "orders"))


def drifting_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, DRIFTING, "payments", payments(spark, sf_dir))


def messages_of(source: DataFrame) -> DataFrame:
    return _view(source.sparkSession, MESSAGES, "payments", source)
