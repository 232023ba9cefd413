"""The message contract as column expressions: decode JSON, coerce, check, explain.

`decode_*` read message bodies through VARIANT, which keeps the JSON type of every
field, so a number is not taken for an identifier and an explicit null is told from
an absent field.  `check_*` work on typed columns and are shared by both paths.  The
result always has an `errors` array with one "field:reason" entry per bad field.

Stricter than the usual lax coercions, on purpose: digit groups ("1_000") and
booleans are not numbers, integers are not IP addresses, repeated keys are errors.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import (
    CHANNELS,
    CITY_LENGTH,
    CURRENCIES,
    IDENTIFIER_LENGTH,
    MAX_AMOUNT,
    OUTCOMES,
    SCHEMA_VERSION,
)
from riskloom.functions.shape import without_nulls

# Accepted spellings.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")
# All characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
MILLISECONDS_ABOVE = 20_000_000_000
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799

HEX = "[0-9a-fA-F]"
DASHED = f"{HEX}{{8}}(-{HEX}{{4}}){{3}}-{HEX}{{12}}"
UUID_PATTERN = rf"^((urn:uuid:)?{DASHED}|\{{{DASHED}\}}|{HEX}{{32}})\z"
CANONICAL_UUID_PATTERN = r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z"
OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"({OCTET}\.){{3}}{OCTET}"
COUNTRY_PATTERN = r"^[A-Z]{2}\z"
NUMBER_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
INTEGER_PATTERN = r"^[+-]?[0-9]+(\.0+)?\z"
ZONED_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?"
    r"([Zz]|[+-][0-9]{2}:?[0-9]{2})\z"
)
# The zoned texts that are cast as they are.
PLAIN_INSTANT_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})\z"
)


def _ipv6_pattern() -> str:
    """Eight groups, or fewer around one '::'."""

    def groups(count: int) -> str:
        return f"{HEX}{{1,4}}(:{HEX}{{1,4}}){{{count - 1}}}" if count else ""

    def up_to(count: int) -> str:
        return f"({HEX}{{1,4}}(:{HEX}{{1,4}}){{0,{count - 1}}})?" if count else ""

    shortened = [f"{groups(left)}::{up_to(7 - left)}" for left in range(8)]
    return rf"^({groups(8)}|{'|'.join(shortened)})(%[^%]+)?\z"


IPV6_PATTERN = _ipv6_pattern()


def strip(text: Column) -> Column:
    """Removes Unicode white space at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def canonical_uuid(text: Column) -> Column:
    """Lower-case dashed form, null when the text is no UUID."""
    digits = F.regexp_replace(F.lower(text), r"^urn:uuid:|[{}-]", "")
    return F.when(text.rlike(CANONICAL_UUID_PATTERN), text).when(
        text.rlike(UUID_PATTERN), F.regexp_replace(digits, *_DASHES)
    )


_DASHES = (r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def is_ip(text: Column) -> Column:
    """IPv4, or IPv6 with an optional IPv4 tail and scope."""
    without_tail = F.regexp_replace(text, rf"(?<=:){IPV4}(?=%|\z)", "0:0")
    return text.rlike(rf"^{IPV4}\z") | without_tail.rlike(IPV6_PATTERN)


def derived_uuid(*parts: Column) -> Column:
    """A version-4 shaped id that is the same whenever the same message is read again."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    return F.regexp_replace(
        F.concat(F.substring(digest, 1, 12), F.lit("4"), F.substring(digest, 14, 3), F.lit("8"),
                 F.substring(digest, 18, 15)),
        *_DASHES,
    )


# --- checks on typed columns -------------------------------------------------------------------


def _transaction_checks() -> dict[str, tuple[Column, str]]:
    """Field -> (condition that must hold, reason when it does not)."""

    def length(name: str, limit: int) -> tuple[Column, str]:
        return F.char_length(name).between(1, limit), "length"

    return {
        "schema_version": (F.col("schema_version") == SCHEMA_VERSION, "choice"),
        "transaction_id": (F.col("transaction_id").isNotNull(), "syntax"),
        "customer_id": length("customer_id", IDENTIFIER_LENGTH),
        "card_id": length("card_id", IDENTIFIER_LENGTH),
        "merchant_id": length("merchant_id", IDENTIFIER_LENGTH),
        "merchant_category": length("merchant_category", IDENTIFIER_LENGTH),
        # NaN sorts above every number, so the upper bounds reject it.
        "amount": ((F.col("amount") > 0) & (F.col("amount") <= MAX_AMOUNT), "range"),
        "currency": (F.col("currency").isin(*CURRENCIES), "choice"),
        "country_code": (F.col("country_code").rlike(COUNTRY_PATTERN), "pattern"),
        "city": length("city", CITY_LENGTH),
        "latitude": (F.col("latitude").between(-90, 90), "range"),
        "longitude": (F.col("longitude").between(-180, 180), "range"),
        "device_id": length("device_id", IDENTIFIER_LENGTH),
        "ip_address": (is_ip(F.col("ip_address")), "syntax"),
        "channel": (F.col("channel").isin(*CHANNELS), "choice"),
        "event_time": (F.col("event_time").isNotNull(), "syntax"),
    }


def _decision_checks() -> dict[str, tuple[Column, str]]:
    return {
        "schema_version": (F.col("schema_version") == SCHEMA_VERSION, "choice"),
        "transaction_id": (F.col("transaction_id").isNotNull(), "syntax"),
        "customer_id": (F.char_length("customer_id").between(1, IDENTIFIER_LENGTH), "length"),
        "event_time": (F.col("event_time").isNotNull(), "syntax"),
        "amount": (F.col("amount").isNotNull(), "type"),
        "currency": (F.col("currency").isin(*CURRENCIES), "choice"),
        "risk_score": (F.col("risk_score").between(0, 100), "range"),
        "rule_risk_score": (F.col("rule_risk_score").between(0, 100), "range"),
        "fraud_probability": (F.col("fraud_probability").between(0, 1), "range"),
        "decision": (F.col("decision").isin(*OUTCOMES), "choice"),
        "triggered_rules": (F.col("triggered_rules").isNotNull(), "type"),
        "features": (F.col("features.transaction_count_5m") >= 1, "range"),
        "detector_version": (F.col("detector_version").isNotNull(), "type"),
        "processed_at": (F.col("processed_at").isNotNull(), "syntax"),
    }


def _errors(checks: dict[str, tuple[Column, str]], why: dict[str, Column]) -> Column:
    """`why` holds what decoding already found out about a field; it takes precedence."""
    found = []
    for name in (*checks, *[n for n in why if n not in checks]):
        reason = why.get(name)
        if name in checks:
            holds, text = checks[name]
            broken = F.when(~F.coalesce(holds, F.lit(False)), F.lit(text))
            reason = broken if reason is None else F.coalesce(reason, broken)
        found.append(F.concat(F.lit(f"{name}:"), reason))
    return without_nulls(*found)


def _computed_once(df: DataFrame) -> DataFrame:
    """The same rows behind a generator, which the optimizer moves no filter across.

    Otherwise a filter on `errors` sinks below the decoding, every column in it is
    replaced by its whole expression, and the plan grows with each layer.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


IDENTIFIERS = (
    "customer_id", "card_id", "merchant_id", "merchant_category", "city", "device_id"
)


def check_transactions(df: DataFrame) -> DataFrame:
    """Normalises typed transactions and adds `errors`; empty means the row is valid.

    A transaction_id that is no UUID is kept as it came, so it can be reported.
    """
    missing = {
        name: F.when(F.col(name).isNull(), F.lit("missing")) for name in _transaction_checks()
    }
    missing["transaction_id"] = F.when(F.col("given_id").isNull(), F.lit("missing"))
    normalised = {name: strip(F.col(name)) for name in IDENTIFIERS} | {
        "given_id": F.col("transaction_id"),
        "transaction_id": canonical_uuid(F.col("transaction_id")),
    }
    return _computed_once(
        df.withColumns(normalised)
        .withColumn("errors", _errors(_transaction_checks(), missing))
        .withColumn("transaction_id", F.coalesce("transaction_id", "given_id"))
        .drop("given_id")
    )


# --- JSON bodies --------------------------------------------------------------------------------


def _document(df: DataFrame, body: str) -> DataFrame:
    """Adds `doc`, the single JSON object in the body, or null.

    The parser stops after the first value, so the text is wrapped: anything behind
    the object then breaks the array, or the enclosing object for a stray "]".  Such a
    one directly follows the object's end, so only texts with "}]" are parsed twice.
    """
    text = F.col("_text")
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    closes_early = text.rlike(r"\}[ \t\n\r]*\]") & F.try_parse_json(
        F.concat(F.lit('{"d":'), text, F.lit("}"))
    ).isNull()
    root = F.try_variant_get("_wrapped", "$[0]", "variant")
    alone = F.try_variant_get("_wrapped", "$[1]", "variant").isNull()
    is_object = text.rlike(r"^[ \t\n\r]*\{")
    return (
        df.withColumn("_text", F.col(body).cast("string"))
        .withColumn("_wrapped", F.when(F.is_valid_utf8("_text") & ~closes_early, wrapped))
        .withColumn("doc", F.when(is_object & alone, root))
        .drop("_text", "_wrapped")
    )


# Decoding goes through layers of scratch columns, each computed once and then used by
# name: `_o_` an object's fields, `_v_` the field as VARIANT, `_t_` its type tag, `_s_` its
# text, `_n_` its number, `_p_` the stripped text, `_d_` the number read from either form.


def _scratch(kind: str, name: str) -> Column:
    return F.col(f"_{kind}_{name}")


def _is_number(tag: Column) -> Column:
    return tag.isin("BIGINT", "DOUBLE") | tag.startswith("DECIMAL")


def _fields(value: Column, names: list[str]) -> Column:
    """The named fields of an object as a struct of VARIANT, found in one pass over it; null for anything else."""
    return F.try_variant_get(value, "$", f"struct<{', '.join(f'`{name}`: variant' for name in names)}>")


def _lay_out(
    df: DataFrame, paths: dict[str, str], texts: tuple[str, ...], numbers: tuple[str, ...]
) -> DataFrame:
    """Scratch columns for `paths`; `numbers` may also come as text."""

    def number_from_text(name: str) -> Column:
        text = _scratch("p", name)
        return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))

    def when_text(name: str) -> Column:
        text = F.try_variant_get(_scratch("v", name), "$", "string")
        return F.when(_scratch("t", name) == "STRING", text)

    def when_number(name: str) -> Column:
        number = F.try_variant_get(_scratch("v", name), "$", "double")
        return F.when(_is_number(_scratch("t", name)), number)

    # One level of nesting: the names of the root's fields, and below some of them those of theirs.
    inner: dict[str, list[str]] = {}
    for path in paths.values():
        parent, _, child = path.partition(".")
        inner.setdefault(parent, []).extend([child] if child else [])
    root = {"_o_": _fields(F.col("doc"), list(inner))}
    nested = {f"_o_{parent}": _fields(F.col("_o_")[parent], names) for parent, names in inner.items() if names}
    fields = {}
    for name, path in paths.items():
        parent, _, child = path.partition(".")
        fields[f"_v_{name}"] = F.col(f"_o_{parent}")[child] if child else F.col("_o_")[parent]
    tags = {f"_t_{name}": F.schema_of_variant(_scratch("v", name)) for name in paths}
    forms = {f"_s_{name}": when_text(name) for name in (*texts, *numbers)}
    forms |= {f"_n_{name}": when_number(name) for name in numbers}
    trimmed = [name for name in (*texts, *numbers) if name in IDENTIFIERS or name in numbers]
    stripped = {f"_p_{name}": strip(_scratch("s", name)) for name in trimmed}
    read = {
        f"_d_{name}": F.coalesce(_scratch("n", name), number_from_text(name)) for name in numbers
    }
    for layer in (root, nested, fields, tags, forms, stripped, read):
        df = df.withColumns(layer)
    return df


def _as_text(name: str) -> Column:
    return _scratch("s", name)


def _as_stripped(name: str) -> Column:
    return _scratch("p", name)


def _as_double(name: str) -> Column:
    return _scratch("d", name)


def _as_int(name: str) -> Column:
    """A whole number; as text it may only have zeros behind the point."""
    number = _as_double(name)
    as_text = _scratch("s", name).isNull() | _scratch("p", name).rlike(INTEGER_PATTERN)
    return F.when((number == F.floor(number)) & as_text, number).try_cast("int")


def _as_boolean(name: str) -> Column:
    value, tag = _scratch("v", name), _scratch("t", name)
    native = F.when(tag == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
    word = F.lower(F.when(tag == "STRING", F.try_variant_get(value, "$", "string")))
    number = F.when(_is_number(tag), F.try_variant_get(value, "$", "double"))
    return F.coalesce(
        native,
        F.when(word.isin(*TRUE_WORDS) | (number == 1), True).when(
            word.isin(*FALSE_WORDS) | (number == 0), False
        ),
    )


def _as_instant(name: str) -> Column:
    """Text with an explicit offset, or seconds / milliseconds since 1970."""
    text, number = _as_text(name), _as_double(name)
    # The only letters of a zoned text are these two.
    full = F.regexp_replace(F.translate(text, "tz", "TZ"), r"^(.{16})(?=[Z+-])", "$1:00")
    exact = F.regexp_replace(full, r"(\.[0-9]{6})[0-9]+", "$1")
    seconds = F.when(F.abs(number) > MILLISECONDS_ABOVE, number / 1000).otherwise(number)
    micros = F.when(
        seconds.between(FIRST_SECOND, LAST_SECOND), F.rint(seconds * 1_000_000).cast("long")
    )
    return (
        F.when(text.rlike(PLAIN_INSTANT_PATTERN), text.try_cast("timestamp"))
        .when(text.rlike(ZONED_PATTERN), exact.try_cast("timestamp"))
        .otherwise(F.timestamp_micros(micros))
    )


def _as_version(name: str) -> Column:
    """Absent means the current version."""
    return F.when(_scratch("t", name).isNull(), F.lit(SCHEMA_VERSION)).otherwise(_as_text(name))


def _why(name: str, typed: Column, optional: bool = False) -> Column:
    """Reason found while decoding, null when the value could be read."""
    tag = _scratch("t", name)
    reason = F.when(F.lit(not optional) & tag.isNull(), "missing")
    return reason.when(tag.isNotNull() & typed.isNull(), "type")


def _decoded(df: DataFrame, values: dict[str, Column], optional: tuple, checks, extra_why) -> DataFrame:
    """Typed columns, then errors; scratch columns are dropped."""
    typed = df.withColumns(values)
    why = {name: _why(name, F.col(name), name in optional) for name in values} | extra_why
    unreadable = F.array(F.lit("body:json"))
    scratch = [c for c in typed.columns if c[:3] in ("_o_", "_v_", "_t_", "_s_", "_n_", "_p_", "_d_")]
    return _computed_once(
        typed.withColumn(
            "errors", F.when(F.col("doc").isNull(), unreadable).otherwise(_errors(checks, why))
        ).drop(*scratch, "doc")
    )


TRANSACTION_FIELDS = (
    "schema_version", "transaction_id", "customer_id", "card_id", "merchant_id",
    "merchant_category", "amount", "currency", "country_code", "city", "latitude", "longitude",
    "device_id", "ip_address", "channel", "event_time",
)


def decode_transactions(messages: DataFrame, identity: tuple[str, ...] = ("partition", "offset")) -> DataFrame:
    """Message rows (with a `value` body) -> typed transaction columns and `errors`.

    Only named fields are read, so unknown ones are ignored.  An absent transaction_id
    is derived from the message and its place, so a replay yields the same one.
    """
    paths = {name: name for name in TRANSACTION_FIELDS} | {
        "simulation": "simulation",
        "is_fraud": "simulation.is_fraud",
        "scenario": "simulation.scenario",
    }
    numbers = ("amount", "latitude", "longitude", "event_time")
    texts = tuple(n for n in TRANSACTION_FIELDS if n not in numbers) + ("scenario",)
    laid_out = _lay_out(_document(messages, "value"), paths, texts, numbers)
    fresh = derived_uuid(F.col("value").cast("string"), *[F.col(c).cast("string") for c in identity])
    values = {name: _as_stripped(name) for name in IDENTIFIERS}
    values |= {name: _as_text(name) for name in ("currency", "country_code", "ip_address", "channel")}
    values |= {name: _as_double(name) for name in ("amount", "latitude", "longitude")}
    values |= {
        "schema_version": _as_version("schema_version"),
        "transaction_id": F.when(F.col("_t_transaction_id").isNull(), fresh).otherwise(
            canonical_uuid(_as_text("transaction_id"))
        ),
        "event_time": _as_instant("event_time"),
    }
    simulated = F.col("_t_simulation")
    is_fraud, scenario = _as_boolean("is_fraud"), _as_text("scenario")
    absent = simulated.isNull() | (simulated == "VOID")
    scenario_ok = F.col("_t_scenario").isNull() | F.col("_t_scenario").isin("VOID", "STRING")
    bad_simulation = F.when(
        ~absent & ~(simulated.startswith("OBJECT") & is_fraud.isNotNull() & scenario_ok), "type"
    )
    simulation = F.when(
        ~absent & bad_simulation.isNull(),
        F.struct(is_fraud.alias("is_fraud"), scenario.alias("scenario")),
    )
    return _decoded(
        laid_out.withColumn("simulation", simulation),
        {name: values[name] for name in TRANSACTION_FIELDS},
        ("schema_version", "transaction_id"),
        _transaction_checks(),
        {"simulation": bad_simulation},
    ).withColumn("label", F.col("simulation.is_fraud"))


def decode_decisions(messages: DataFrame) -> DataFrame:
    """Message rows -> typed decision columns and `errors`."""
    plain = (
        "schema_version", "transaction_id", "customer_id", "event_time", "amount", "currency",
        "risk_score", "rule_risk_score", "fraud_probability", "decision", "triggered_rules",
        "features", "detector_version", "processed_at", "simulation_is_fraud",
    )
    flags = ("is_new_device", "is_new_country", "is_risky_merchant")
    inner = ("amount", "transaction_count_5m", *flags)
    paths = {name: name for name in plain} | {f"f_{name}": f"features.{name}" for name in inner}
    numbers = (
        "event_time", "processed_at", "amount", "risk_score", "rule_risk_score",
        "fraud_probability", "f_amount", "f_transaction_count_5m",
    )
    texts = (
        "schema_version", "transaction_id", "customer_id", "currency", "decision",
        "detector_version",
    )
    laid_out = _lay_out(_document(messages, "value"), paths, texts, numbers)

    rules_tag = _scratch("t", "triggered_rules")
    rules = F.try_variant_get(_scratch("v", "triggered_rules"), "$", "array<string>")
    rules = F.when(
        rules_tag.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(rules, lambda r: r.isNull()), rules
    )
    snapshot = {
        "amount": _as_double("f_amount"),
        "transaction_count_5m": _as_int("f_transaction_count_5m"),
    } | {name: _as_boolean(f"f_{name}") for name in flags}
    complete = F.lit(True)
    for value in snapshot.values():
        complete = complete & value.isNotNull()
    rule_score = F.when(F.col("_t_rule_risk_score").isNull(), F.lit(0)).otherwise(
        _as_int("rule_risk_score")
    )
    values = {
        "schema_version": _as_version("schema_version"),
        "transaction_id": canonical_uuid(_as_text("transaction_id")),
        "customer_id": _as_stripped("customer_id"),
        "event_time": _as_instant("event_time"),
        "amount": _as_double("amount"),
        "currency": _as_text("currency"),
        "risk_score": _as_int("risk_score"),
        "rule_risk_score": rule_score,
        "fraud_probability": _as_double("fraud_probability"),
        "decision": _as_text("decision"),
        "triggered_rules": rules,
        "features": F.when(complete, F.struct(*[v.alias(n) for n, v in snapshot.items()])),
        "detector_version": _as_text("detector_version"),
        "processed_at": _as_instant("processed_at"),
    }
    label_tag, label = F.col("_t_simulation_is_fraud"), _as_boolean("simulation_is_fraud")
    bad_label = F.when((label_tag != "VOID") & label.isNull(), "type")
    return _decoded(
        laid_out.withColumn("simulation_is_fraud", label),
        values,
        ("schema_version", "rule_risk_score"),
        _decision_checks(),
        {"simulation_is_fraud": bad_label},
    )


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") == 0).drop("errors")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") > 0)


def to_message(
    records: DataFrame, key: str, columns: tuple[str, ...], keep: tuple[str, ...] = ()
) -> DataFrame:
    """key and JSON value; instants in ISO form with their zone, null fields written out."""
    options = {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "ignoreNullFields": "false",
    }
    return records.select(
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*columns), options).cast("binary").alias("value"),
        *keep,
    )


def acceptance(transactions: DataFrame, accepted_at: Column | None = None) -> DataFrame:
    """The receipt for each accepted transaction."""
    return transactions.select(
        "transaction_id",
        F.lit("accepted").alias("status"),
        (F.current_timestamp() if accepted_at is None else accepted_at).alias("accepted_at"),
    )
