"""Equivalent SQL for the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"
EVENTS_AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
DAY = "86400000000.0"
NUMBERS = ("country_code", "amount", "value", "pricing_strategy", "fraud_result")
LABELLED_NUMBERS = (*NUMBERS, "recency_score", "frequency_score", "monetary_score", "std_score", "rfms_score")
TEXTS = (
    "transaction_id", "batch_id", "account_id", "subscription_id", "customer_id", "currency_code",
    "provider_id", "product_id", "product_category", "channel_id",
)
ALL = (
    "transaction_id", "batch_id", "account_id", "subscription_id", "customer_id", "currency_code", "country_code",
    "provider_id", "product_id", "product_category", "channel_id", "amount", "value", "txn_ts", "pricing_strategy",
    "fraud_result",
)
TYPES = {"country_code": "int", "pricing_strategy": "int", "fraud_result": "int", "amount": "double", "value": "double", "txn_ts": "timestamp_ntz"}
IDS = ("transaction_id", "batch_id", "account_id", "subscription_id", "customer_id", "provider_id", "product_id", "channel_id")
ORDER = "txn_ts, transaction_id, provider_id, product_id, product_category, value, amount, account_id"


def score(x: str, low: str, high: str, ascending: bool = True) -> str:
    step = f"(({high} - {low}) / 5.0::DOUBLE)"
    above = " + ".join(f"CASE WHEN {x} > {low} + {i}.0::DOUBLE * {step} THEN 1 ELSE 0 END" for i in range(1, 5))
    total = f"(1 + {above})"
    return f"CASE WHEN {low} = {high} THEN 3.0::DOUBLE ELSE ({total if ascending else '6 - ' + total})::DOUBLE END"


def measures(as_of: str) -> str:
    return f"""
      CAST(floor(date_diff('microsecond', max(txn_ts), {as_of}) / {DAY}::DOUBLE) AS BIGINT) AS recency,
      count(transaction_id) AS frequency, coalesce(sum(value), 0.0::DOUBLE) AS monetary,
      coalesce(stddev_samp(value), 0.0::DOUBLE) AS std_deviation"""


AMOUNTS = """coalesce(sum(amount), 0.0::DOUBLE) AS total_transaction, avg(amount) AS average_transaction,
      count(transaction_id) AS transaction_count, stddev_samp(amount) AS std_transaction"""
AMOUNTS_OUT = ", ".join(
    ["round(total_transaction, 4) AS total_transaction", "round(average_transaction + 1e-7::DOUBLE, 4) AS average_transaction", "transaction_count", "round(std_transaction, 4) AS std_transaction"]
)


def scoring(source: str, suffix: str = "") -> str:
    return f"""
    bounds{suffix} AS (SELECT min(recency)::DOUBLE r0, max(recency)::DOUBLE r1, min(frequency)::DOUBLE f0, max(frequency)::DOUBLE f1,
      min(monetary) m0, max(monetary) m1, min(std_deviation) s0, max(std_deviation) s1 FROM {source}),
    parts{suffix} AS (SELECT {source}.*, {score('recency::DOUBLE', 'r0', 'r1', False)} AS recency_score,
      {score('frequency::DOUBLE', 'f0', 'f1')} AS frequency_score, {score('monetary', 'm0', 'm1')} AS monetary_score,
      {score('std_deviation', 's0', 's1', False)} AS std_score FROM {source}, bounds{suffix}),
    scored{suffix} AS (SELECT *, round(recency_score * 0.1::DOUBLE + frequency_score * 0.2::DOUBLE + monetary_score * 0.5::DOUBLE
      + std_score * 0.2::DOUBLE, 10) AS rfms_score FROM parts{suffix}),
    cut{suffix} AS (SELECT quantile_cont(rfms_score, 0.55) AS boundary FROM scored{suffix}),
    labels_of{suffix} AS (SELECT scored{suffix}.*, CASE WHEN rfms_score <= boundary THEN 'Bad' ELSE 'Good' END AS risk_label
      FROM scored{suffix}, cut{suffix})"""


def stacked(columns, source: str, keep: str = "") -> str:
    casts = ", ".join(f"{c}::DOUBLE AS {c}" for c in columns)
    extra = f"{keep}, " if keep else ""
    return f"SELECT * FROM (UNPIVOT (SELECT {extra}{casts} FROM {source}) ON {', '.join(columns)} INTO NAME variable VALUE x)"


def stacked_texts(columns, source: str, keep: str = "") -> str:
    extra = f"{keep}, " if keep else ""
    return f"SELECT * FROM (UNPIVOT (SELECT {extra}{', '.join(columns)} FROM {source}) ON {', '.join(columns)} INTO NAME variable VALUE x)"


FIFTHS = "[0.0, 0.2, 0.4, 0.6000000000000001, 0.8, 1.0]"  # multiples of one step

VIEWS = {
    "transactions": """transactions AS (
      SELECT concat('TransactionId_', l_orderkey * 10 + l_linenumber) AS transaction_id, concat('BatchId_', l_orderkey) AS batch_id,
        concat('AccountId_', o_custkey * 10 + l_suppkey % 3) AS account_id,
        concat('SubscriptionId_', o_custkey * 10 + l_linenumber % 2) AS subscription_id,
        concat('CustomerId_', o_custkey) AS customer_id, 'UGX' AS currency_code, CAST(256 AS INT) AS country_code,
        concat('ProviderId_', l_suppkey % 6 + 1) AS provider_id, concat('ProductId_', l_partkey % 23 + 1) AS product_id,
        p_type AS product_category, concat('ChannelId_', substr(o_orderpriority, 1, 1)) AS channel_id,
        CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount, l_extendedprice AS value,
        l_shipdate + to_hours(CAST((l_orderkey * 7 + l_linenumber) % 24 AS INT)) AS txn_ts,
        CAST(l_linenumber % 5 AS INT) AS pricing_strategy,
        CAST(CASE WHEN l_linestatus = 'O' AND l_quantity >= 49 THEN 1 ELSE 0 END AS INT) AS fraud_result
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)""",
    "dated": """dated AS (SELECT *, CAST(hour(txn_ts) AS INT) AS hour, CAST(day(txn_ts) AS INT) AS day,
      CAST(month(txn_ts) AS INT) AS month, CAST(year(txn_ts) AS INT) AS year FROM transactions)""",
    "event_transactions": """event_transactions AS (
      SELECT concat('TransactionId_', event_id) AS transaction_id, concat('CustomerId_', user_id) AS customer_id,
        event_type AS product_category, CASE WHEN event_type = 'error' THEN -value ELSE value END AS amount, value, ts AS txn_ts
      FROM events)""",
    "with_gaps": """with_gaps AS (SELECT transaction_id, customer_id, nullif(product_category, 'error') AS product_category, amount,
      CASE WHEN value >= 5 THEN value END AS value, txn_ts FROM event_transactions)""",
    "rfms": f"rfms AS (SELECT customer_id, {measures(AS_OF)} FROM transactions GROUP BY customer_id)",
    "scored": scoring("rfms").strip(),
    "rfms_e": f"rfms_e AS (SELECT customer_id, {measures(EVENTS_AS_OF)} FROM event_transactions GROUP BY customer_id)",
    "scored_e": scoring("rfms_e", "_e").strip(),
    "aggregates": f"aggregates AS (SELECT customer_id, {AMOUNTS} FROM transactions GROUP BY customer_id)",
    "labelled": """labelled AS (SELECT t.*, l.recency_score, l.frequency_score, l.monetary_score, l.std_score, l.rfms_score, l.risk_label
      FROM transactions t LEFT JOIN labels_of l USING (customer_id))""",
    "numeric_woe": f"""long AS ({stacked(LABELLED_NUMBERS, 'labelled', 'risk_label')}),
      edges AS (SELECT variable, list_sort(list_distinct(quantile_cont(x, {FIFTHS}))) AS e FROM long GROUP BY variable),
      binned AS (SELECT variable, risk_label, e, CAST(1 + len(list_filter(e[2:len(e) - 1], lambda v: x > v)) AS INT) AS bin_id
        FROM long JOIN edges USING (variable) WHERE len(e) >= 2),
      counts AS (SELECT variable, bin_id, any_value(e[bin_id]) AS lower, any_value(e[bin_id + 1]) AS upper,
        count(*) FILTER (WHERE risk_label = 'Good') AS good, count(*) FILTER (WHERE risk_label = 'Bad') AS bad, count(*) AS total
        FROM binned GROUP BY variable, bin_id),
      nwoe AS (SELECT *, bad / total AS bad_rate,
        ln(((good + 0.5::DOUBLE) / (G + 0.5::DOUBLE)) / ((bad + 0.5::DOUBLE) / (B + 0.5::DOUBLE))) AS woe, good / G - bad / B AS share
        FROM (SELECT *, sum(good) OVER (PARTITION BY variable)::DOUBLE AS G, sum(bad) OVER (PARTITION BY variable)::DOUBLE AS B FROM counts))""",
    "category_woe": f"""texts AS ({stacked_texts(('currency_code', 'provider_id', 'product_id', 'product_category', 'channel_id'), 'labelled', 'risk_label')}),
      few AS (SELECT variable FROM texts GROUP BY variable HAVING count(DISTINCT x) <= 10),
      ccounts AS (SELECT variable, CAST(row_number() OVER (PARTITION BY variable ORDER BY x) AS INT) AS bin_id, x AS label,
        good, bad, total FROM (SELECT variable, x, count(*) FILTER (WHERE risk_label = 'Good') AS good,
        count(*) FILTER (WHERE risk_label = 'Bad') AS bad, count(*) AS total FROM texts SEMI JOIN few USING (variable) GROUP BY variable, x)),
      cwoe AS (SELECT *, bad / total AS bad_rate,
        ln(((good + 0.5::DOUBLE) / (G + 0.5::DOUBLE)) / ((bad + 0.5::DOUBLE) / (B + 0.5::DOUBLE))) AS woe, good / G - bad / B AS share
        FROM (SELECT *, sum(good) OVER (PARTITION BY variable)::DOUBLE AS G, sum(bad) OVER (PARTITION BY variable)::DOUBLE AS B FROM ccounts))""",
}
NEEDS = {
    "dated": ["transactions"],
    "with_gaps": ["event_transactions"],
    "rfms": ["transactions"],
    "scored": ["rfms"],
    "rfms_e": ["event_transactions"],
    "scored_e": ["rfms_e"],
    "aggregates": ["transactions"],
    "labelled": ["scored"],
    "numeric_woe": ["labelled"],
    "category_woe": ["labelled"],
}


def over(views: str, body: str) -> str:
    """``body`` with the named views, and those they need, in front."""
    chain: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in chain:
            chain.append(name)

    for name in views.split():
        add(name)
    return "WITH " + ",\n".join(VIEWS[n] for n in chain) + "\n" + body


def histogram(source: str, series: dict[str, str], bins: int) -> str:
    parts = " UNION ALL ".join(f"SELECT '{n}' AS variable, {e} AS x FROM {source}" for n, e in series.items())
    return f"""SELECT variable, bin, round(low + bin * w, 6) AS lower,
      round(CASE WHEN bin = {bins - 1} THEN high ELSE low + (bin + 1) * w END, 6) AS upper, count(*) AS n
      FROM (SELECT variable, low, high, w, CAST(least(floor((x - low) / w), {bins - 1}) AS INT) AS bin
        FROM (SELECT variable, x, low, high, (high - low) / {bins}::DOUBLE AS w FROM
          (SELECT variable, x, CASE WHEN a = b THEN a - 0.5 ELSE a END AS low, CASE WHEN a = b THEN b + 0.5 ELSE b END AS high FROM
            (SELECT *, min(x) OVER (PARTITION BY variable) AS a, max(x) OVER (PARTITION BY variable) AS b
             FROM ({parts}) WHERE x IS NOT NULL))))
      GROUP BY variable, bin, low, high, w"""


def log10_of(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN log10({x}) END"


def column_rows(source: str, expression: str) -> str:
    """One row per column of the transactions table."""
    return " UNION ALL ".join(expression.format(c=c, i=i + 1, t=TYPES.get(c, "string"), source=source) for i, c in enumerate(ALL))


PSI = """counted AS (SELECT channel_id AS value, count(*) FILTER (WHERE txn_ts < TIMESTAMP '2000-01-01') AS a,
      count(*) FILTER (WHERE txn_ts >= TIMESTAMP '2000-01-01') AS b FROM transactions GROUP BY 1),
    shares AS (SELECT value, a / sum(a) OVER ()::DOUBLE AS p, b / sum(b) OVER ()::DOUBLE AS q FROM counted),
    floored AS (SELECT *, greatest(p, 1e-6::DOUBLE) AS p1, greatest(q, 1e-6::DOUBLE) AS q1 FROM shares)"""


def md5_share(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE"


def scaled(c: str, places: int = 6, shift: float = 0.0) -> str:
    return (
        f"round(({c}::DOUBLE - avg({c}::DOUBLE) OVER ()) / "
        f"CASE WHEN stddev_pop({c}::DOUBLE) OVER () = 0 THEN 1.0::DOUBLE ELSE stddev_pop({c}::DOUBLE) OVER () END + {shift}::DOUBLE, {places}) AS {c}"
    )


def number_of(c: str) -> str:
    return f"CAST(split_part({c}, '_', 2) AS BIGINT) AS {c}"


def pairs() -> str:
    names = ("amount", "value", "pricing_strategy", "fraud_result", "hour", "day", "month", "year")
    return " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round({f'CASE WHEN stddev_pop({a}) > 0 THEN 1.0::DOUBLE END' if a == b else f'corr({a}::DOUBLE, {b}::DOUBLE)'}, 6) AS correlation FROM dated"
        for a in names
        for b in names
    )


# The label follows from the score alone, so a tree of sufficient depth learns it without error.
SCORED_REQUESTS = """SELECT rfms_score, recency_score, CAST(pricing_strategy AS VARCHAR) AS pricing_strategy, product_category, risk_label,
        NULL::VARCHAR AS _error, count(*) AS n FROM labelled GROUP BY ALL"""
GROUPED_LABELS = "risk_label, count(*) AS n"
OUTLIER = "quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3"
FEATURE_NUMBERS = (*NUMBERS, "hour", "day", "month", "year", "total_transaction", "average_transaction", "transaction_count", "std_transaction")

# Edges, counts and evidence of every variable in every segment.
SEGMENT_TEXTS = ("currency_code", "provider_id", "product_id", "channel_id")
SEGMENTS = f""", long AS ({stacked(LABELLED_NUMBERS, 'labelled', 'product_category, risk_label')}),
  edges AS (SELECT product_category, variable, list_sort(list_distinct(quantile_cont(x, {FIFTHS}))) AS e FROM long GROUP BY 1, 2),
  texts AS ({stacked_texts(SEGMENT_TEXTS, 'labelled', 'product_category, risk_label')}),
  few AS (SELECT variable FROM texts GROUP BY variable HAVING count(DISTINCT x) <= 10),
  counts AS (
    SELECT product_category, variable, bin_id, e[bin_id] AS lower, e[bin_id + 1] AS upper,
      count(*) FILTER (WHERE risk_label = 'Good') AS good, count(*) FILTER (WHERE risk_label = 'Bad') AS bad, count(*) AS total
    FROM (SELECT *, CAST(1 + len(list_filter(e[2:len(e) - 1], lambda v: x > v)) AS INT) AS bin_id
          FROM long JOIN edges USING (product_category, variable) WHERE len(e) >= 2) GROUP BY ALL
    UNION ALL
    SELECT product_category, variable, CAST(row_number() OVER (PARTITION BY product_category, variable ORDER BY x) AS INT), NULL, NULL, good, bad, total
    FROM (SELECT product_category, variable, x, count(*) FILTER (WHERE risk_label = 'Good') AS good,
          count(*) FILTER (WHERE risk_label = 'Bad') AS bad, count(*) AS total FROM texts SEMI JOIN few USING (variable) GROUP BY 1, 2, 3)),
  segments AS (
    SELECT *, ln(((good + 0.5::DOUBLE) / (G + 0.5::DOUBLE)) / ((bad + 0.5::DOUBLE) / (B + 0.5::DOUBLE))) AS woe,
      coalesce(good / nullif(G, 0), 0) - coalesce(bad / nullif(B, 0), 0) AS share
    FROM (SELECT *, sum(good) OVER w::DOUBLE AS G, sum(bad) OVER w::DOUBLE AS B FROM counts WINDOW w AS (PARTITION BY product_category, variable)))"""

# Rows of a label: the first ranks are the test part, the others five folds in turn.
PARTS = """, sizes AS (SELECT CASE WHEN risk_label = 'Good' THEN 1 ELSE 0 END AS label, count(*) AS n FROM labelled WHERE risk_label IS NOT NULL GROUP BY 1),
  cuts AS (SELECT label, n, i, CASE WHEN i = 0 THEN 0 WHEN i = 6 THEN n ELSE ceil((n - 1) * (0.3::DOUBLE + 0.7::DOUBLE * (i - 1) / 5)) END AS upto
    FROM sizes, range(7) t(i)),
  pieces AS (SELECT a.label::INT AS label, CASE WHEN a.i = 0 THEN 'test' ELSE 'train' END AS part, CASE WHEN a.i > 0 THEN a.i - 1 END::INT AS fold,
    (b.upto - a.upto)::BIGINT AS n FROM cuts a JOIN cuts b ON b.label = a.label AND b.i = a.i + 1)"""

ORACLES = {
    "scan_transactions": over("transactions", "SELECT * FROM transactions"),
    "first_rows": over("transactions", f"SELECT * FROM transactions ORDER BY {ORDER} LIMIT 5"),
    "write_features": over("dated aggregates", f"SELECT d.*, {AMOUNTS_OUT} FROM dated d LEFT JOIN aggregates USING (customer_id)"),
    "parse_ts_lenient": over("event_transactions", "SELECT transaction_id, date_trunc('second', txn_ts) AS txn_ts FROM event_transactions WHERE product_category <> 'error'"),
    "date_features": over("dated", "SELECT transaction_id, txn_ts, hour, day, month, year FROM dated"),
    "parse_ids": over("transactions", f"SELECT {', '.join(number_of(c) for c in IDS)} FROM transactions"),
    "drop_missing": over("with_gaps", "SELECT * FROM with_gaps WHERE product_category IS NOT NULL AND value IS NOT NULL AND amount IS NOT NULL AND txn_ts IS NOT NULL"),
    "credit_debit_split": over(
        "event_transactions",
        """SELECT CASE WHEN amount < 0 THEN 'credit' ELSE 'debit' END AS direction, count(*) AS n, round(sum(abs(amount)), 4) AS volume,
        max(abs(amount)) AS largest FROM event_transactions WHERE amount IS NOT NULL GROUP BY 1""",
    ),
    "customer_rows": over("transactions", "SELECT * FROM transactions WHERE customer_id = 'CustomerId_7'"),
    "encode_label": over("scored", "SELECT customer_id, CAST(CASE WHEN risk_label = 'Good' THEN 1 ELSE 0 END AS INT) AS label FROM labels_of"),
    "customer_aggregates_joined": over("aggregates", f"SELECT t.*, {AMOUNTS_OUT} FROM transactions t LEFT JOIN aggregates USING (customer_id)"),
    "label_transactions": over("labelled", "SELECT * FROM labelled"),
    "rfms": over("rfms", "SELECT customer_id, recency, frequency, round(monetary, 4) AS monetary, round(std_deviation, 4) AS std_deviation FROM rfms"),
    "customer_aggregates": over("aggregates", f"SELECT customer_id, {AMOUNTS_OUT} FROM aggregates"),
    "customer_profile": over(
        "event_transactions",
        f"""SELECT customer_id, recency, frequency, round(monetary, 4) AS monetary, round(std_deviation, 4) AS std_deviation, {AMOUNTS_OUT}
        FROM (SELECT customer_id, {measures(EVENTS_AS_OF)}, {AMOUNTS} FROM event_transactions GROUP BY customer_id)""",
    ),
    "value_counts": over("transactions", "SELECT product_id, count(*) AS n FROM transactions GROUP BY 1"),
    "distinct_values": over("with_gaps", "SELECT DISTINCT product_category FROM with_gaps"),
    "cardinality": over("transactions", column_rows("transactions", "SELECT '{c}' AS variable, count(DISTINCT {c}) AS n_values FROM {source}")),
    "describe_numeric": over(
        "transactions",
        f"""SELECT variable, count(x) AS count, round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, round(min(x), 4) AS min,
        round(max(x), 4) AS max, round(quantile_cont(x, 0.25), 4) AS q25, round(quantile_cont(x, 0.5), 4) AS q50,
        round(quantile_cont(x, 0.75), 4) AS q75 FROM ({stacked(NUMBERS, 'transactions')}) GROUP BY variable""",
    ),
    "overview": over("transactions", column_rows("transactions", "SELECT CAST({i} AS INT) AS position, '{c}' AS variable, '{t}' AS dtype, count(*) AS n_rows, count({c}) AS n_values FROM {source}")),
    "hourly_counts": over("event_transactions", "SELECT CAST(hour(txn_ts) AS INT) AS hour, count(*) AS n FROM event_transactions GROUP BY 1"),
    "weekday_counts": over(
        "transactions",
        """SELECT CAST(p AS INT) AS position, d AS weekday, count(txn_ts) AS n FROM (VALUES (1, 'Monday'), (2, 'Tuesday'), (3, 'Wednesday'),
        (4, 'Thursday'), (5, 'Friday'), (6, 'Saturday'), (7, 'Sunday')) w(p, d) LEFT JOIN transactions ON dayname(txn_ts) = d GROUP BY p, d""",
    ),
    "daily_counts": over("transactions", "SELECT date_trunc('day', txn_ts)::TIMESTAMP AS day, count(*) AS n FROM transactions GROUP BY 1"),
    "quantiles": over(
        "transactions",
        f"""SELECT variable, p::DOUBLE AS probability, round(q, 6) AS quantile FROM (SELECT variable, unnest([0.05, 0.25, 0.5, 0.55, 0.75, 0.95]) AS p,
        unnest(quantile_cont(x, [0.05, 0.25, 0.5, 0.55, 0.75, 0.95])) AS q FROM ({stacked(('amount', 'value'), 'transactions')}) GROUP BY variable)""",
    ),
    "correlation_long": over("dated", pairs()),
    "missing_values": over(
        "with_gaps",
        """SELECT variable, n_missing, round(n_missing * 100.0 / n, 6) AS percent FROM (
        SELECT 'product_category' AS variable, count(*) - count(product_category) AS n_missing, count(*) AS n FROM with_gaps
        UNION ALL SELECT 'value', count(*) - count(value), count(*) FROM with_gaps
        UNION ALL SELECT 'amount', count(*) - count(amount), count(*) FROM with_gaps
        UNION ALL SELECT 'customer_id', count(*) - count(customer_id), count(*) FROM with_gaps
        UNION ALL SELECT 'transaction_id', count(*) - count(transaction_id), count(*) FROM with_gaps
        UNION ALL SELECT 'txn_ts', count(*) - count(txn_ts), count(*) FROM with_gaps) WHERE n_missing > 0""",
    ),
    "outliers_value": over(
        "event_transactions",
        f"""SELECT 'value' AS part, count(*) AS n_rows, count(*) FILTER (WHERE value < lo OR value > hi) AS n_outliers,
        round(count(*) FILTER (WHERE value < lo OR value > hi) * 100.0 / count(*), 6) AS percent, round(any_value(lo), 6) AS lower, round(any_value(hi), 6) AS upper
        FROM event_transactions, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT {OUTLIER.format(x='value')} FROM event_transactions))""",
    ),
    "outliers_amount_split": over(
        "event_transactions",
        f"""SELECT 'debit' AS part, count(*) AS n_rows, count(*) FILTER (WHERE amount > hi) AS n_outliers,
        round(count(*) FILTER (WHERE amount > hi) * 100.0 / count(*), 6) AS percent, NULL::DOUBLE AS lower, round(any_value(hi), 6) AS upper
        FROM event_transactions, (SELECT q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT {OUTLIER.format(x='amount')} FROM event_transactions WHERE amount >= 0)) WHERE amount >= 0
        UNION ALL SELECT 'credit', count(*), count(*) FILTER (WHERE amount < lo), round(count(*) FILTER (WHERE amount < lo) * 100.0 / count(*), 6), round(any_value(lo), 6), NULL
        FROM event_transactions, (SELECT q1 - 1.5 * (q3 - q1) AS lo FROM (SELECT {OUTLIER.format(x='amount')} FROM event_transactions WHERE amount < 0)) WHERE amount < 0""",
    ),
    "top_outliers": over(
        "event_transactions",
        f"""SELECT transaction_id, value, product_category FROM event_transactions,
        (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT {OUTLIER.format(x='value')} FROM event_transactions))
        WHERE value < lo OR value > hi ORDER BY value DESC, transaction_id LIMIT 5""",
    ),
    "customer_accounts": over("transactions", "SELECT account_id, count(*) AS n FROM transactions WHERE customer_id = 'CustomerId_7' GROUP BY 1"),
    "account_samples": over(
        "transactions",
        f"""SELECT CAST(position AS INT) AS position, transaction_id, account_id, product_category, amount, value, txn_ts FROM
        (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY {ORDER}) AS position FROM transactions) WHERE position <= 5""",
    ),
    "top_categories": over(
        "transactions",
        f"""SELECT variable, value, n, CAST(position AS INT) AS position FROM (SELECT variable, x AS value, count(*) AS n,
        row_number() OVER (PARTITION BY variable ORDER BY count(*) DESC, x) AS position
        FROM ({stacked_texts([c for c in TEXTS if c not in ('transaction_id', 'batch_id', 'subscription_id')], 'transactions')})
        GROUP BY variable, x) WHERE position <= 10""",
    ),
    "top_customer_accounts": over(
        "transactions",
        """SELECT account_id, count(*) AS n FROM transactions WHERE customer_id =
        (SELECT customer_id FROM transactions GROUP BY 1 ORDER BY count(*) DESC, customer_id LIMIT 1) GROUP BY 1""",
    ),
    "equal_width_scores": over("scored", "SELECT customer_id, recency_score, frequency_score, monetary_score, std_score FROM scored"),
    "rfms_scores": over("scored", "SELECT customer_id, rfms_score FROM scored"),
    "quantile_scores": over(
        "rfms",
        f"""SELECT customer_id, (1 + len(list_filter(f[2:5], lambda v: frequency > v)))::DOUBLE AS frequency_score,
        (1 + len(list_filter(m[2:5], lambda v: monetary > v)))::DOUBLE AS monetary_score,
        (5 - len(list_filter(s[2:5], lambda v: std_deviation > v)))::DOUBLE AS std_score
        FROM rfms, (SELECT quantile_cont(frequency::DOUBLE, {FIFTHS}) AS f, quantile_cont(monetary, {FIFTHS}) AS m, quantile_cont(std_deviation, {FIFTHS}) AS s FROM rfms)""",
    ),
    "risk_labels": over(
        "scored",
        """SELECT customer_id, recency, frequency, round(monetary, 4) AS monetary, round(std_deviation, 4) AS std_deviation,
        recency_score, frequency_score, monetary_score, std_score, rfms_score, risk_label FROM labels_of""",
    ),
    "risk_labels_events": over("scored_e", "SELECT customer_id, recency_score, frequency_score, rfms_score, risk_label FROM labels_of_e"),
    "label_boundary": over("scored", "SELECT round(boundary, 8) AS boundary FROM cut"),
    "label_counts": over("scored", f"SELECT {GROUPED_LABELS} FROM labels_of GROUP BY risk_label"),
    "quantile_bins": over(
        "transactions",
        f"""SELECT variable, CAST(i AS INT) AS bin_id, round(e[i], 6) AS lower, round(e[i + 1], 6) AS upper FROM
        (SELECT variable, e, unnest(range(1, len(e))) AS i FROM (SELECT variable, list_sort(list_distinct(quantile_cont(x, {FIFTHS}))) AS e
        FROM ({stacked(NUMBERS, 'transactions')}) GROUP BY variable))""",
    ),
    "categorical_bin_columns": over(
        "transactions",
        f"""SELECT variable, count(DISTINCT x) AS n_values FROM ({stacked_texts(('currency_code', 'provider_id', 'product_id', 'product_category', 'channel_id'), 'transactions')})
        GROUP BY variable HAVING count(DISTINCT x) <= 10""",
    ),
    "woe_counts_numeric": over("numeric_woe", "SELECT variable, bin_id, round(lower, 6) AS lower, round(upper, 6) AS upper, good, bad, total FROM counts"),
    "woe_counts_categorical": over("category_woe", "SELECT variable, bin_id, label, good, bad FROM ccounts"),
    "woe_numeric": over("numeric_woe", "SELECT variable, bin_id, good, bad, round(woe, 6) AS woe, round(share * woe, 6) AS iv_part FROM nwoe"),
    "woe_categorical": over("category_woe", "SELECT variable, label AS bin, good, bad, round(woe, 6) AS woe, round(share * woe, 6) AS iv_part FROM cwoe"),
    "bad_rate": over(
        "numeric_woe category_woe",
        "SELECT variable, bin_id, round(bad_rate, 6) AS bad_rate FROM nwoe UNION ALL SELECT variable, bin_id, round(bad_rate, 6) FROM cwoe",
    ),
    "iv_numeric": over(
        "numeric_woe",
        "SELECT e.variable, round(coalesce(sum(share * woe), 0.0::DOUBLE), 6) AS iv FROM edges e LEFT JOIN nwoe w ON e.variable = w.variable GROUP BY 1",
    ),
    "iv_categorical": over("category_woe", "SELECT variable, round(sum(share * woe), 6) AS iv FROM cwoe GROUP BY 1"),
    "iv_strength": over(
        "numeric_woe category_woe",
        """SELECT variable, round(iv, 6) AS iv, CASE WHEN iv > 0.5 THEN 'strong' WHEN iv BETWEEN 0.1 AND 0.3 THEN 'medium' WHEN iv < 0.02 THEN 'weak'
        ELSE 'unspecified' END AS strength FROM (SELECT variable, sum(share * woe) AS iv FROM
        (SELECT variable, share, woe FROM nwoe UNION ALL SELECT variable, share, woe FROM cwoe) GROUP BY 1)""",
    ),
    "woe_report": over(
        "numeric_woe",
        """SELECT bin_id, printf('(%.3f, %.3f]', lower, upper) AS bin, good, bad, round(bad_rate, 6) AS bad_probability, round(woe, 6) AS woe
        FROM nwoe WHERE variable = 'amount'""",
    ),
    "woe_transform": over(
        "numeric_woe category_woe",
        f""", numbers AS ({stacked(LABELLED_NUMBERS, 'labelled', 'transaction_id')}),
        texts_of AS ({stacked_texts(('currency_code', 'provider_id', 'product_id', 'product_category', 'channel_id'), 'labelled', 'transaction_id')})
        SELECT transaction_id, n.variable, round(w.woe, 6) AS woe FROM numbers n JOIN edges USING (variable)
        JOIN nwoe w ON w.variable = n.variable AND w.bin_id = 1 + len(list_filter(e[2:len(e) - 1], lambda v: n.x > v)) WHERE len(e) >= 2
        UNION ALL SELECT transaction_id, t.variable, round(w.woe, 6) FROM texts_of t JOIN cwoe w ON w.variable = t.variable AND w.label = t.x""",
    ),
    "woe_by_segment": over(
        "labelled",
        SEGMENTS + """ SELECT product_category, variable, bin_id, round(lower, 6) AS lower, round(upper, 6) AS upper, good, bad,
          round(bad / total, 6) AS bad_rate, round(woe, 6) AS woe FROM segments""",
    ),
    "iv_by_segment": over(
        "labelled", SEGMENTS + " SELECT product_category, variable, round(sum(share * woe), 6) AS iv FROM segments GROUP BY 1, 2"
    ),
    "scorecard_roundtrip": over("labelled", "SELECT count(*) AS n, count(*) AS n_equal FROM labelled"),
    "standardize": over("transactions", f"SELECT transaction_id, {', '.join(scaled(c) for c in NUMBERS)} FROM transactions"),
    "scaler_params": over("transactions", f"SELECT variable, round(avg(x), 4) AS mean, round(stddev_pop(x), 4) AS std FROM ({stacked(NUMBERS, 'transactions')}) GROUP BY 1"),
    "label_encode": over(
        "transactions",
        """SELECT transaction_id, CAST(dense_rank() OVER (ORDER BY product_id) - 1 AS INT) AS product_id,
        CAST(dense_rank() OVER (ORDER BY product_category) - 1 AS INT) AS product_category,
        CAST(dense_rank() OVER (ORDER BY channel_id) - 1 AS INT) AS channel_id FROM transactions""",
    ),
    "label_encode_many": over(
        "transactions",
        """SELECT CAST(dense_rank() OVER (ORDER BY transaction_id) - 1 AS INT) AS transaction_id,
        CAST(dense_rank() OVER (ORDER BY account_id) - 1 AS INT) AS account_id FROM transactions""",
    ),
    "interaction_vectors": over(
        "transactions",
        """SELECT transaction_id, product_id, CAST((SELECT count(DISTINCT product_id) FROM transactions) AS INT) AS size,
        CAST(dense_rank() OVER (ORDER BY product_id) - 1 AS INT) AS position, amount AS value FROM transactions""",
    ),
    "feature_table": over(
        "dated aggregates",
        f""", joined AS (SELECT d.*, a.* EXCLUDE (customer_id) FROM dated d LEFT JOIN aggregates a USING (customer_id))
        SELECT {', '.join(number_of(c) for c in IDS)}, txn_ts,
        CAST(dense_rank() OVER (ORDER BY currency_code) - 1 AS INT) AS currency_code,
        CAST(dense_rank() OVER (ORDER BY product_category) - 1 AS INT) AS product_category,
        {', '.join(scaled(c, 4, 1e-7 if c == 'average_transaction' else 0.0) for c in FEATURE_NUMBERS)} FROM joined""",
    ),
    "artefact_roundtrip": over(
        "labelled",
        f""", stats AS ({stacked(NUMBERS, 'labelled')}),
        texts AS ({stacked_texts(('currency_code', 'provider_id', 'product_id', 'product_category', 'channel_id'), 'labelled')}),
        edges AS (SELECT variable, list_sort(list_distinct(quantile_cont(x, {FIFTHS}))) AS e FROM stats GROUP BY variable)
        SELECT 'scaler' AS kind, variable, 'mean' AS item, round(avg(x), 4) AS number FROM stats GROUP BY variable
        UNION ALL SELECT 'scaler', variable, 'deviation', round(stddev_pop(x), 4) FROM stats GROUP BY variable
        UNION ALL SELECT 'encoder', variable, x, (row_number() OVER (PARTITION BY variable ORDER BY x) - 1)::DOUBLE FROM (SELECT DISTINCT variable, x FROM texts)
        UNION ALL SELECT 'bins', variable, concat('edge ', i), round(e[i + 1], 4) FROM (SELECT *, unnest(range(len(e))) AS i FROM edges)
        UNION ALL SELECT 'model', 'risk_label', risk_label, count(*)::DOUBLE FROM labelled GROUP BY risk_label""",
    ),
    "stratified_split": over(
        "transactions",
        f"""SELECT transaction_id, product_id, value, CASE WHEN {md5_share("concat_ws('|', transaction_id, product_id, '69')")} < 0.3 THEN 'test' ELSE 'train' END AS part
        FROM transactions""",
    ),
    "exact_stratified_split": over(
        "scored",
        f"""SELECT customer_id, risk_label, CASE WHEN h < cut THEN 'test' ELSE 'train' END AS part FROM
        (SELECT *, quantile_cont(h, 0.3) OVER (PARTITION BY risk_label) AS cut FROM
        (SELECT customer_id, risk_label, {md5_share("concat_ws('|', customer_id, '69')")} AS h FROM labels_of))""",
    ),
    "class_weights": over(
        "scored",
        """SELECT CAST(label AS INT) AS label, n, round(max(n) OVER () / n, 6) AS weight FROM
        (SELECT CASE WHEN risk_label = 'Good' THEN 1 ELSE 0 END AS label, count(*) AS n FROM labels_of GROUP BY 1)""",
    ),
    "classification_metrics": over(
        "labelled",
        """, judged AS (SELECT risk_label = 'Good' AS y, value > 50000 AS z, value / (value + 50000.0::DOUBLE) AS p FROM labelled),
        c AS (SELECT count(*) FILTER (WHERE y AND z)::DOUBLE AS tp, count(*) FILTER (WHERE NOT y AND z)::DOUBLE AS fp,
          count(*) FILTER (WHERE y AND NOT z)::DOUBLE AS fn, count(*) FILTER (WHERE NOT y AND NOT z)::DOUBLE AS tn FROM judged),
        points AS (SELECT p, count(*) FILTER (WHERE y)::DOUBLE AS a, count(*) FILTER (WHERE NOT y)::DOUBLE AS b FROM judged GROUP BY p),
        area AS (SELECT sum(a * (below + b / 2)) / (sum(a) * sum(b)) AS auc FROM
          (SELECT a, b, coalesce(sum(b) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM points))
        SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
        round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(auc, 6) AS roc_auc FROM c, area""",
    ),
    "batch_scoring": over("labelled", SCORED_REQUESTS),
    "winner_scoring": over("labelled", SCORED_REQUESTS),
    "training_parts": over("labelled", PARTS + " SELECT * FROM pieces"),
    "synthetic_training": over(
        "labelled",
        PARTS + """, minority AS (SELECT label FROM pieces WHERE part = 'train' GROUP BY label ORDER BY sum(n), label LIMIT 1)
        SELECT label, fold, CASE WHEN label = (SELECT label FROM minority) THEN max(n) OVER (PARTITION BY fold) ELSE n END AS n, TRUE AS within
        FROM pieces WHERE part = 'train'""",
    ),
    "stream_scoring": over("labelled", SCORED_REQUESTS),
    "histogram_linear": over("transactions", histogram("transactions", {c: f"{c}::DOUBLE" for c in ("country_code", "amount", "value", "pricing_strategy", "fraud_result")}, 15)),
    "histogram_log": over("event_transactions", histogram("event_transactions", {"value": log10_of("value")}, 30)),
    "histogram_credit_debit": over("event_transactions", histogram("event_transactions", {"credit": log10_of("(-amount)"), "debit": log10_of("amount")}, 30)),
    "boxplot_stats": over(
        "event_transactions",
        f""", signed AS (SELECT value, CASE WHEN amount < 0 THEN -amount END AS credit, CASE WHEN amount >= 0 THEN amount END AS debit FROM event_transactions),
        long AS ({stacked(('value', 'credit', 'debit'), 'signed')}),
        q AS (SELECT variable, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2, quantile_cont(x, 0.75) AS q3 FROM long GROUP BY variable),
        f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
        SELECT variable, round(any_value(q1), 6) AS q25, round(any_value(q2), 6) AS q50, round(any_value(q3), 6) AS q75,
        round(min(x) FILTER (WHERE x >= lo AND x <= hi), 6) AS whisker_low, round(max(x) FILTER (WHERE x >= lo AND x <= hi), 6) AS whisker_high,
        count(*) FILTER (WHERE x < lo OR x > hi) AS n_outliers FROM long JOIN f USING (variable) GROUP BY variable""",
    ),
    "density_curve": over(
        "transactions",
        f""", series AS ({" UNION ALL ".join(f"SELECT '{c}' AS variable, 'plain' AS axis, {c}::DOUBLE AS v FROM transactions" for c in NUMBERS)}
          UNION ALL SELECT 'value', 'log', {log10_of('value')} FROM transactions UNION ALL SELECT 'credit', 'log', {log10_of('(-amount)')} FROM transactions
          UNION ALL SELECT 'debit', 'log', {log10_of('amount')} FROM transactions),
        s AS (SELECT variable, axis, count(v)::DOUBLE AS n, stddev_samp(v) * count(v)::DOUBLE ** (-0.2::DOUBLE) AS h, min(v) AS lo, max(v) AS hi FROM series GROUP BY 1, 2),
        grid AS (SELECT *, CAST(i AS INT) AS point, lo + i * ((hi - lo) / 49) AS x FROM s, range(0, 50) t(i) WHERE h > 0),
        merged AS (SELECT variable, axis, v, count(*) AS c FROM series WHERE v IS NOT NULL GROUP BY ALL)
        SELECT variable, axis, point, round(x, 8) AS x, round(sum(c * exp(-0.5 * ((x - v) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())) * any_value((hi - lo) / 49), 5) AS mass
        FROM grid JOIN merged USING (variable, axis) GROUP BY variable, axis, point, x""",
    ),
    # The best of all cuts of the sorted scores.
    "kmeans_1d_boundary": over(
        "scored",
        """, points AS (SELECT rfms_score AS x, count(*)::DOUBLE AS n FROM scored GROUP BY 1),
        halves AS (SELECT sum(n) OVER w AS n1, sum(n * x) OVER w AS s1, sum(n) OVER () AS n2, sum(n * x) OVER () AS s2 FROM points WINDOW w AS (ORDER BY x)),
        best AS (SELECT s1 / n1 AS a, (s2 - s1) / (n2 - n1) AS b FROM halves WHERE n1 < n2 ORDER BY s1 * s1 / n1 + (s2 - s1) * (s2 - s1) / (n2 - n1) DESC LIMIT 1)
        SELECT round(a, 6) AS lower_centre, round(b, 6) AS upper_centre, round((a + b) / 2, 6) AS boundary FROM best""",
    ),
    "score_scatter": over("scored", "SELECT rfms_score, monetary_score, count(*) AS n FROM scored GROUP BY 1, 2"),
    "account_flow_features": over(
        "transactions",
        """SELECT account_id, round(coalesce(sum(amount) FILTER (WHERE amount >= 0), 0.0::DOUBLE), 6) AS total_debit,
        round(coalesce(sum(-amount) FILTER (WHERE amount < 0), 0.0::DOUBLE), 6) AS total_credit, count(*) FILTER (WHERE amount >= 0) AS n_debit,
        count(*) FILTER (WHERE amount < 0) AS n_credit, round(count(*) FILTER (WHERE amount < 0) / count(amount), 6) AS credit_fraction,
        max(amount) FILTER (WHERE amount >= 0) AS max_debit, max(-amount) FILTER (WHERE amount < 0) AS max_credit FROM transactions GROUP BY 1""",
    ),
    "log_and_cap": over(
        "event_transactions",
        f"""SELECT transaction_id, round(ln(1 + value), 6) AS log_value, round(greatest(lo, least(hi, value)), 6) AS capped_value FROM event_transactions,
        (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT {OUTLIER.format(x='value')} FROM event_transactions))""",
    ),
    "user_tier": over(
        "event_transactions",
        """SELECT CASE WHEN value BETWEEN 50 AND 500 THEN 'tier_1' WHEN value BETWEEN 1000 AND 5000 THEN 'tier_2' WHEN value >= 10000 THEN 'tier_3'
        WHEN value IS NOT NULL THEN 'other' END AS user_tier, count(*) AS n, round(sum(value), 4) AS volume FROM event_transactions GROUP BY 1""",
    ),
    "group_rare": over(
        "transactions",
        """SELECT CASE WHEN product_id IN (SELECT product_id FROM transactions GROUP BY 1 ORDER BY count(*) DESC, product_id LIMIT 5) THEN product_id
        ELSE 'Other' END AS product_id, count(*) AS n FROM transactions GROUP BY 1""",
    ),
    "interaction_terms": over(
        "transactions",
        "SELECT transaction_id, product_category, "
        + ", ".join(
            f"CASE WHEN product_category = '{c}' THEN amount ELSE 0.0::DOUBLE END AS amount_x_{c}"
            for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
        )
        + " FROM transactions",
    ),
    "accounts_per_customer": over(
        "transactions", "SELECT customer_id, count(DISTINCT account_id) AS n_accounts, count(*) AS n_transactions FROM transactions GROUP BY 1"
    ),
    "channel_drift": over(
        "transactions",
        f", {PSI} SELECT value, round(p, 8) AS share_before, round(q, 8) AS share_after, round((q1 - p1) * ln(q1 / p1), 8) AS psi_part FROM floored",
    ),
    "channel_drift_index": over("transactions", f", {PSI} SELECT round(sum((q1 - p1) * ln(q1 / p1)), 8) AS psi FROM floored"),
}
