"""Plain SQL over the driver's tables that the Spark queries are compared with.

The statements below share their common table expressions; `sql` puts a statement
together from the ones it needs.
"""

from riskloom.config import PUBLISHED_ARTIFACT as MODEL

EPOCH = 1_704_067_200_000_000

_COUNTRY = "CASE place WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB' WHEN 3 THEN 'DE' END"

_TERMS = " + ".join(
    f"({weight}::DOUBLE * ((x{i} - {mean}::DOUBLE) / {scale}::DOUBLE))"
    for i, (weight, mean, scale) in enumerate(
        zip(MODEL["coefficients"], MODEL["scaler_mean"], MODEL["scaler_scale"], strict=True)
    )
)
_A, _B = MODEL["calibration"]["a"], MODEL["calibration"]["b"]

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Field, what breaks it, reason.
_CHECKS = (
    ("schema_version", "schema_version <> '1.0'", "choice"),
    (
        "transaction_id",
        "NOT regexp_full_match(transaction_id, '[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}')",
        "syntax",
    ),
    ("customer_id", "length(trim(customer_id)) NOT BETWEEN 1 AND 64", "length"),
    ("card_id", "length(trim(card_id)) NOT BETWEEN 1 AND 64", "length"),
    ("merchant_id", "length(trim(merchant_id)) NOT BETWEEN 1 AND 64", "length"),
    ("merchant_category", "length(trim(merchant_category)) NOT BETWEEN 1 AND 64", "length"),
    ("amount", "NOT (amount > 0 AND amount <= 1000000)", "range"),
    ("currency", "currency NOT IN ('USD', 'EUR', 'GBP', 'CAD')", "choice"),
    ("country_code", "NOT regexp_full_match(country_code, '[A-Z]{2}')", "pattern"),
    ("city", "length(trim(city)) NOT BETWEEN 1 AND 100", "length"),
    ("latitude", "latitude NOT BETWEEN -90 AND 90", "range"),
    ("longitude", "longitude NOT BETWEEN -180 AND 180", "range"),
    ("device_id", "length(trim(device_id)) NOT BETWEEN 1 AND 64", "length"),
    (
        "ip_address",
        f"NOT regexp_full_match(ip_address, '({_OCTET}[.]){{3}}{_OCTET}|[0-9a-f]{{1,4}}(:[0-9a-f]{{0,4}}){{2,7}}')",
        "syntax",
    ),
    ("channel", "channel NOT IN ('card_present', 'ecommerce', 'mobile')", "choice"),
)


def _reasons(first: dict[str, str] | None = None, last: str = "NULL") -> str:
    """The broken fields as one text; `first` has cases that go before a field's check."""
    cases = [
        f"CASE {(first or {}).get(field, '')} WHEN {broken} THEN '{field}:{reason}' END"
        for field, broken, reason in _CHECKS
    ]
    return f"concat_ws(';', {', '.join(cases)}, {last})"


CTES = {
    "e": (
        [],
        f"""SELECT event_id, user_id, event_type, value,
            CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
            {EPOCH} + (epoch_us(ts) - {EPOCH}) // 250 AS us
        FROM events""",
    ),
    "p": (
        ["e"],
        """SELECT *, round(value * 20, 2) AS gross,
            CASE WHEN k BETWEEN 50 AND 52 THEN (user_id % 4 + 1) % 4 ELSE user_id % 4 END AS place,
            CASE event_type WHEN 'purchase' THEN 'electronics' WHEN 'click' THEN 'digital_goods'
                WHEN 'view' THEN 'grocery' WHEN 'signup' THEN 'travel'
                WHEN 'error' THEN 'dining' END AS merchant_category
        FROM e""",
    ),
    "txn": (
        ["p"],
        f"""SELECT event_id AS seq, '1.0' AS schema_version, k, user_id, us,
            '00000000-' || lpad(CAST(event_id // 1000000000000000 AS VARCHAR), 4, '0') || '-4000-8'
                || lpad(CAST(event_id // 1000000000000 % 1000 AS VARCHAR), 3, '0') || '-'
                || lpad(CAST(event_id % 1000000000000 AS VARCHAR), 12, '0') AS transaction_id,
            'customer-' || user_id AS customer_id, 'card-' || user_id AS card_id,
            'merchant-' || merchant_category AS merchant_id, merchant_category,
            CASE WHEN k = 13 THEN -gross ELSE gross END AS amount,
            CASE place WHEN 0 THEN 'USD' WHEN 1 THEN 'CAD' WHEN 2 THEN 'GBP' WHEN 3 THEN 'EUR' END
                AS currency,
            CASE WHEN k = 17 THEN 'USA' ELSE {_COUNTRY} END AS country_code,
            CASE place WHEN 0 THEN 'Boston' WHEN 1 THEN 'Toronto' WHEN 2 THEN 'London'
                WHEN 3 THEN 'Berlin' END AS city,
            CASE WHEN k = 21 THEN 91.0 ELSE 50.0 END AS latitude, 0.0 AS longitude,
            CASE WHEN k >= 95 THEN 'new-device-' || event_id ELSE 'device-' || user_id END
                AS device_id,
            '198.51.100.' || (1 + k) AS ip_address,
            CASE k % 3 WHEN 0 THEN 'card_present' WHEN 1 THEN 'ecommerce' WHEN 2 THEN 'mobile' END
                AS channel,
            CASE WHEN k % 10 <> 7 THEN
                k >= 92 OR (CASE WHEN k = 13 THEN -gross ELSE gross END >= 2500 AND k % 2 = 0)
            END AS label
        FROM p""",
    ),
    "checked": (["txn"], f"SELECT *, {_reasons()} AS errors FROM txn"),
    # One field broken or written unusually, as in derived.faulty_messages.
    "faulty": (
        ["txn"],
        """SELECT * REPLACE (
            CASE fault WHEN 1 THEN repeat('x', 65) WHEN 29 THEN NULL ELSE customer_id END AS customer_id,
            CASE fault WHEN 3 THEN '' ELSE card_id END AS card_id,
            CASE fault WHEN 4 THEN '   ' ELSE merchant_id END AS merchant_id,
            CASE fault WHEN 5 THEN repeat('m', 64) ELSE merchant_category END AS merchant_category,
            CASE fault WHEN 6 THEN repeat('é', 100) WHEN 7 THEN repeat('é', 101) ELSE city END AS city,
            CASE fault WHEN 10 THEN NULL ELSE transaction_id END AS transaction_id,
            CASE fault WHEN 12 THEN 'JPY' WHEN 13 THEN 'usd' ELSE currency END AS currency,
            CASE fault WHEN 14 THEN '256.1.1.1' WHEN 15 THEN '2001:db8::1' WHEN 16 THEN '1.2.3'
                ELSE ip_address END AS ip_address,
            CASE fault WHEN 17 THEN 'phone' ELSE channel END AS channel,
            CASE fault WHEN 18 THEN 180.5 WHEN 19 THEN -180.0 ELSE longitude END AS longitude,
            CASE fault WHEN 20 THEN -90.5 ELSE latitude END AS latitude,
            CASE fault WHEN 21 THEN 1000000.01::DOUBLE WHEN 22 THEN 1000000::DOUBLE
                WHEN 30 THEN 12.5::DOUBLE WHEN 31 THEN NULL ELSE amount END AS amount,
            CASE fault WHEN 23 THEN '2.0' ELSE schema_version END AS schema_version,
            CASE fault WHEN 24 THEN 'us' WHEN 25 THEN NULL ELSE country_code END AS country_code,
            CASE fault WHEN 26 THEN NULL ELSE device_id END AS device_id)
        FROM (SELECT *, seq % 32 AS fault FROM txn)""",
    ),
    "refused": (
        ["faulty"],
        "SELECT *, "
        + _reasons(
            {
                "transaction_id": "WHEN transaction_id IS NULL THEN 'transaction_id:type'",
                "customer_id": "WHEN customer_id IS NULL THEN 'customer_id:type'",
                "amount": "WHEN amount IS NULL THEN 'amount:type'",
                "country_code": "WHEN country_code IS NULL THEN 'country_code:missing'",
                "device_id": "WHEN device_id IS NULL THEN 'device_id:missing'",
            },
            "CASE fault WHEN 27 THEN 'event_time:missing' WHEN 28 THEN 'simulation:type' END",
        )
        + " AS errors FROM faulty",
    ),
    "ok": (["checked"], "SELECT * FROM checked WHERE errors = ''"),
    "feat": (
        ["ok"],
        """SELECT *,
            CAST(count(*) OVER (PARTITION BY customer_id ORDER BY us
                    RANGE BETWEEN 300000000 PRECEDING AND CURRENT ROW)
                - count(*) OVER (PARTITION BY customer_id, us)
                + row_number() OVER (PARTITION BY customer_id, us ORDER BY seq) AS INTEGER)
                AS transaction_count_5m,
            row_number() OVER (PARTITION BY customer_id ORDER BY us, seq) > 1
                AND row_number() OVER (PARTITION BY customer_id, device_id ORDER BY us, seq) = 1
                AS is_new_device,
            row_number() OVER (PARTITION BY customer_id ORDER BY us, seq) > 1
                AND row_number() OVER (PARTITION BY customer_id, country_code ORDER BY us, seq) = 1
                AS is_new_country,
            merchant_category IN ('digital_goods', 'electronics') AS is_risky_merchant
        FROM ok""",
    ),
    "vec": (
        ["feat"],
        """SELECT *, ln(1 + amount) AS x0, CAST(transaction_count_5m AS DOUBLE) AS x1,
            CAST(is_new_device AS DOUBLE) AS x2, CAST(is_new_country AS DOUBLE) AS x3,
            CAST(is_risky_merchant AS DOUBLE) AS x4,
            amount >= 2500 AS r1, transaction_count_5m >= 5 AS r2, is_new_device AS r3,
            is_new_country AS r4, is_risky_merchant AND amount >= 500 AS r5
        FROM feat""",
    ),
    "raw": (["vec"], f"SELECT *, {MODEL['intercept']}::DOUBLE + {_TERMS} AS raw_logit FROM vec"),
    "lg": (["raw"], f"SELECT *, {_A}::DOUBLE * raw_logit + ({_B}::DOUBLE) AS logit FROM raw"),
    "pr": (
        ["lg"],
        """SELECT *,
            CASE WHEN logit >= 0 THEN 1 / (1 + exp(-logit)) ELSE exp(logit) / (1 + exp(logit)) END
                AS fraud_probability,
            concat_ws(',', CASE WHEN r1 THEN 'high_amount' END,
                CASE WHEN r2 THEN 'high_velocity' END, CASE WHEN r3 THEN 'new_device' END,
                CASE WHEN r4 THEN 'new_country' END,
                CASE WHEN r5 THEN 'risky_merchant_amount' END) AS rules,
            least(100, CASE WHEN r1 THEN 60 ELSE 0 END + CASE WHEN r2 THEN 35 ELSE 0 END
                + CASE WHEN r3 THEN 20 ELSE 0 END + CASE WHEN r4 THEN 25 ELSE 0 END
                + CASE WHEN r5 THEN 20 ELSE 0 END) AS rule_risk_score
        FROM lg""",
    ),
    "sc": (
        ["pr"],
        """SELECT *, greatest(rule_risk_score,
            CAST(round_even(100 * fraud_probability, 0) AS INTEGER)) AS risk_score FROM pr""",
    ),
    "dec": (
        ["sc"],
        """SELECT *, CASE WHEN risk_score >= 70 THEN 'decline' WHEN risk_score >= 40 THEN 'review'
            ELSE 'approve' END AS decision,
            'hybrid-rules-v1+logreg-v1' AS detector_version, us + k * 1000 AS processed_us
        FROM sc""",
    ),
    "log": (
        ["dec"],
        """SELECT * REPLACE (seq * 2 AS seq) FROM dec
        UNION ALL
        SELECT * REPLACE (seq * 2 + 1 AS seq, least(100, risk_score + 1) AS risk_score,
            processed_us + CASE WHEN k % 4 = 0 THEN 1000000 WHEN k % 4 = 1 THEN -1000000 ELSE 0 END
                AS processed_us)
        FROM dec WHERE k % 4 = 0 OR k % 4 = 1 OR k % 8 = 2""",
    ),
    "lab": (["dec"], "SELECT *, fraud_probability AS s FROM dec WHERE label IS NOT NULL"),
    "numbered": (
        ["lab"],
        """SELECT *, row_number() OVER (ORDER BY us, seq) - 1 AS place, count(*) OVER () AS n
        FROM lab""",
    ),
    "cut": (
        ["numbered"],
        """SELECT *, CASE WHEN place < floor(n * 0.7::DOUBLE) THEN 'train'
            WHEN place < floor(n * 0.8::DOUBLE) THEN 'calibration' ELSE 'test' END AS split
        FROM numbered""",
    ),
    "offs": (
        ["txn"],
        """SELECT *, user_id % 3 AS part, high - k * 20 AS behind,
            CASE WHEN k = 99 OR high - k * 20 < 0 THEN 0 ELSE greatest(k * 20, 0) END AS lag
        FROM (SELECT *, count(*) OVER (PARTITION BY user_id % 3 ORDER BY seq
                ROWS UNBOUNDED PRECEDING) AS high FROM txn)""",
    ),
    "pm": (
        ["checked"],
        f"""SELECT (us - {EPOCH}) // 60000000 AS m, count(*) AS accepted,
            count(*) FILTER (WHERE errors = ''
                AND (us - {EPOCH}) // 60000000 NOT BETWEEN 60 AND 74) AS scored,
            count(*) FILTER (WHERE errors <> '') AS failed
        FROM checked GROUP BY 1""",
    ),
    "ms": (
        ["pm"],
        f"""SELECT metric, {EPOCH} + (m + 1) * 60000000 AS taken,
            sum(added) OVER (PARTITION BY metric, m >= 120 ORDER BY m) AS v
        FROM (SELECT m, 'api_transactions' AS metric, accepted AS added FROM pm
            UNION ALL SELECT m, 'detector_transactions', scored FROM pm
            UNION ALL SELECT m, 'detector_failures', failed FROM pm)""",
    ),
    "steps": (
        ["ms"],
        """SELECT metric, taken, lag(taken) OVER w AS prior,
            CASE WHEN v >= lag(v) OVER w THEN v - lag(v) OVER w
                WHEN lag(v) OVER w IS NOT NULL THEN v END AS grown
        FROM ms WINDOW w AS (PARTITION BY metric ORDER BY taken)""",
    ),
    "fm": (
        ["dec"],
        f"""SELECT metric, {EPOCH} + (m + 1) * 60000000 AS taken,
            sum(added) OVER (PARTITION BY metric, m >= 120 ORDER BY m) AS v
        FROM (SELECT (us - {EPOCH}) // 60000000 AS m, 'store_failures' AS metric,
                count(*) FILTER (WHERE seq % 16 = 1) AS added FROM dec GROUP BY 1
            UNION ALL SELECT (us - {EPOCH}) // 60000000, 'alert_failures',
                count(*) FILTER (WHERE decision = 'decline') FROM dec GROUP BY 1)""",
    ),
    "req": (
        ["e"],
        """SELECT event_id AS request_id, event_type AS route, us AS started,
            us + CAST(round(value * 1000) AS BIGINT) AS finished, value / 1000 AS seconds
        FROM e""",
    ),
}

CTES["fsteps"] = (["fm"], CTES["steps"][1].replace("FROM ms", "FROM fm"))




def newton_sql(source: str, inputs: list[str], steps: int = 25) -> str:
    """The body of a recursive table (step, w0, w1, ...) of Newton steps for a logistic fit; the last weight is the
    intercept and the only one without penalty.  `source` has the inputs, `y` and `wt`.

    A step sums up gradient and Hessian, and solves for the next weights by elimination, one unknown a layer.
    """
    n = len(inputs) + 1
    terms = [*inputs, "1::DOUBLE"]
    weights = ", ".join(f"w{i}" for i in range(n))
    score = " + ".join(f"w{i} * {term}" for i, term in enumerate(terms))
    ridge = [1.0] * (n - 1) + [0.0]
    gradient = [f"sum(wt * (p - y) * {t}) + {r}::DOUBLE * w{i} AS b{i}" for i, (t, r) in enumerate(zip(terms, ridge, strict=True))]
    bends = [
        f"sum(wt * p * (1 - p) * {terms[i]} * {terms[j]}) + {ridge[i] if i == j else 0}::DOUBLE AS h{i}_{j}"
        for i in range(n)
        for j in range(n)
    ]
    layer = f"""SELECT step, {weights}, {", ".join(gradient + bends)}
        FROM (SELECT *, 1 / (1 + exp(-({score}))) AS p FROM fit, {source}) WHERE step < {steps} GROUP BY step, {weights}"""
    for k in range(n):
        rest = [
            f"h{i}_{j} - h{i}_{k} / h{k}_{k} * h{k}_{j} AS h{i}_{j}" for i in range(k + 1, n) for j in range(k + 1, n)
        ]
        rest += [f"b{i} - h{i}_{k} / h{k}_{k} * b{k} AS b{i}" for i in range(k + 1, n)]
        done = [f"h{i}_{j}" for i in range(k + 1) for j in range(i, n)] + [f"b{i}" for i in range(k + 1)]
        layer = f"SELECT step, {weights}, {', '.join(done + rest)} FROM ({layer})"
    for k in reversed(range(n)):
        known = "".join(f" - h{k}_{j} * d{j}" for j in range(k + 1, n))
        layer = f"SELECT *, (b{k}{known}) / h{k}_{k} AS d{k} FROM ({layer})"
    start = ", ".join(f"0::DOUBLE AS w{i}" for i in range(n))
    after = ", ".join(f"w{i} - d{i}" for i in range(n))
    return f"SELECT 0 AS step, {start} UNION ALL SELECT step + 1, {after} FROM ({layer})"


def sql(statement: str, *needs: str) -> str:
    """`statement` with the common table expressions it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in CTES[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    body = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in ordered)
    return f"WITH {body}\n{statement}" if ordered else statement
