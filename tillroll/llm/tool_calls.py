"""Chat formatting: link tool calls with their results, order, check and serialise them.

All of it is DataFrame work. Calls and results meet by identifier in a hash join.
A call may name the call it comes after; those links are followed by doubling, so a
chain of n calls takes log2(n) joins, and no conversation is ever gathered in one
task. Arguments are checked against a schema per tool, as JSON values and not as
text, and each call becomes one line of canonical JSON: keys in order, no spaces.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.llm.common import written

# The function that stands for a plain question and answer.
REPLY = "reply"
SCHEMAS = {
    REPLY: {
        "properties": {
            "text": {"type": "string", "minLength": 1},
            "turn": {"type": "integer", "minimum": 0},
        },
        "required": ["text", "turn"],
        "additionalProperties": False,
    }
}

# JSON types as the names that Spark gives to JSON values.
TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DECIMAL.*|DOUBLE|FLOAT",
    "boolean": "BOOLEAN",
    "array": "ARRAY.*",
    "object": "OBJECT.*",
    "null": "VOID",
}

_CALLS = "tool_calls array<struct<id string, name string, arguments string, after string>>"
_RESULT = "tool_call_id string, content string"


def _parsed(messages):
    """Messages with the calls (``made``) and the result (``given``) that their JSON holds."""
    rows = messages.select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # What is no JSON, or JSON without these fields, gives NULL.
    return rows.withColumns(
        {
            "made": F.when(F.col("role") == "assistant", F.from_json("text", _CALLS)["tool_calls"]),
            "given": F.when(F.col("role") == "tool", F.from_json("text", _RESULT)),
        }
    )


def events(messages):
    """Calls and results out of chat messages (``conv_id``, ``turn``, ``role``, ``text``).

    An assistant's message that is a JSON object with ``tool_calls`` makes calls, a
    ``tool`` message with a ``tool_call_id`` a result. Any other user message is a call
    of :data:`REPLY` under the identifier ``conversation:turn``, after the one two turns
    before, and an assistant's is the result of the call one turn before. Messages
    without conversation or turn, and of other roles, are neither.

    Calls: ``conv_id``, ``call_id``, ``turn``, ``name``, ``arguments``, ``after``.
    Results: ``conv_id``, ``call_id``, ``turn``, ``content``. NULL texts are empty.
    """
    rows = _parsed(messages).where("conv_id IS NOT NULL AND turn IS NOT NULL")

    def place(back):
        return F.concat_ws(":", "conv_id", F.col("turn") - back)

    tool_calls = rows.where("made IS NOT NULL").select("conv_id", "turn", F.explode("made").alias("m"))
    tool_calls = tool_calls.select(
        "conv_id",
        F.col("m.id").alias("call_id"),
        "turn",
        F.col("m.name").alias("name"),
        F.coalesce("m.arguments", F.lit("")).alias("arguments"),
        F.col("m.after").alias("after"),
    ).where("call_id IS NOT NULL")
    asked = rows.where("role = 'user'").select(
        "conv_id",
        place(0).alias("call_id"),
        "turn",
        F.lit(REPLY).alias("name"),
        F.to_json(F.struct("text", "turn")).alias("arguments"),
        F.when(F.col("turn") > 1, place(2)).alias("after"),
    )
    tool_results = rows.where("given.tool_call_id IS NOT NULL").select(
        "conv_id",
        F.col("given.tool_call_id").alias("call_id"),
        "turn",
        F.coalesce("given.content", F.lit("")).alias("content"),
    )
    answered = rows.where("role = 'assistant' AND made IS NULL").select(
        "conv_id", place(1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return tool_calls.unionByName(asked), tool_results.unionByName(answered)


# --- arguments ----------------------------------------------------------------


def _problem(when, text):
    return F.when(when, F.lit(text))


RULES = {"type", "minLength", "maxLength", "minimum", "maximum", "enum", "pattern"}
NESTED = {"properties", "required", "items"}


def _check_keywords(place, rule, known):
    unknown = sorted(set(rule) - known)
    if unknown:
        raise ValueError(f"schema of {place}: unknown keywords {', '.join(unknown)}")


def _kind_fits(own, rule):
    if "type" not in rule:
        return F.lit(True)
    return F.schema_of_variant(own).rlike(f"^({TYPES[rule['type']]})$")


def _checks(own, rule):
    """(condition that is true for a value out of bounds, what to say)."""
    text, number = F.try_variant_get(own, "$", "string"), F.try_variant_get(own, "$", "double")
    checks = {
        "minLength": (lambda x: F.length(text) < x, "too short"),
        "maxLength": (lambda x: F.length(text) > x, "too long"),
        "minimum": (lambda x: number < x, "too small"),
        "maximum": (lambda x: number > x, "too large"),
        "enum": (lambda x: ~text.isin(x), "not among the values"),
        "pattern": (lambda x: ~text.rlike(x), "not of the pattern"),
    }
    return [(test(rule[key]), said) for key, (test, said) in checks.items() if key in rule]


def _property_problems(value, path, name, rule, required):
    """What is wrong with one property, those within it, and the items of a list."""
    _check_keywords(name, rule, RULES | NESTED)
    own = F.try_variant_get(value, path, "variant")
    problems = [_problem(own.isNull(), f"{name}: missing")] if required else []
    fits = _kind_fits(own, rule)
    if "type" in rule:
        problems.append(_problem(own.isNotNull() & ~fits, f"{name}: not {rule['type']}"))
    problems += [
        _problem(own.isNotNull() & fits & bad, f"{name}: {said}") for bad, said in _checks(own, rule)
    ]
    if "items" in rule:
        items = rule["items"]
        _check_keywords(f"{name}[]", items, RULES)

        def bad_item(item):
            bad = ~_kind_fits(item, items)
            for test, _ in _checks(item, items):
                bad = bad | test
            return F.coalesce(bad, F.lit(False))

        listed = F.try_variant_get(value, path, "array<variant>")
        bad = F.coalesce(F.exists(listed, bad_item), F.lit(False))
        problems.append(_problem(bad, f"{name}: item not allowed"))
    inner, needed = rule.get("properties", {}), rule.get("required", [])
    for key in sorted({*inner, *needed}):
        below = _property_problems(
            value, f'{path}["{key}"]', f"{name}.{key}", inner.get(key, {}), key in needed
        )
        # What is no object, or not there, has been said.
        whole = F.coalesce(F.schema_of_variant(own).startswith("OBJECT"), F.lit(False))
        problems += [F.when(whole, problem) for problem in below]
    return problems


def argument_errors(name, arguments, schemas):
    """What is wrong with a call's arguments: an array of texts, empty if nothing is.

    A schema has ``properties``, ``required`` and ``additionalProperties``; a property has
    ``type``, bounds, ``enum`` and ``pattern``, may hold properties itself, and the
    ``items`` of a list have a type and bounds. Any other keyword is a ValueError.
    """
    value = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    keys = F.map_keys(F.from_json(arguments, "map<string, string>"))
    found = F.array(F.lit("name: unknown tool"))
    for tool, schema in schemas.items():
        _check_keywords(tool, schema, {"type", "properties", "required", "additionalProperties"})
        rules = schema.get("properties", {})
        needed = schema.get("required", [])
        problems = [
            p
            for key in sorted({*rules, *needed})
            for p in _property_problems(
                value, f'$["{key}"]', key, rules.get(key, {}), key in needed
            )
        ]
        errors = F.array_compact(F.array(*problems)) if problems else F.array().cast("array<string>")
        if schema.get("additionalProperties") is False:
            known = F.array(*[F.lit(k) for k in rules]).cast("array<string>")
            extra = F.array_sort(F.array_except(keys, known))
            errors = F.concat(
                errors, F.transform(extra, lambda k: F.concat(k, F.lit(": unexpected")))
            )
        found = F.when(name == tool, errors).otherwise(found)
    return F.when(is_object, found).otherwise(F.array(F.lit("arguments: not a JSON object")))


# --- order --------------------------------------------------------------------


def depths(calls):
    """``conv_id``, ``call_id``, ``depth``: how many calls a call comes after, one by one.

    A call that names no other call of its conversation is at depth 0. Calls of a
    circle, and those behind one, have NULL.
    """
    nodes = calls.select("conv_id", "call_id", "after")
    known = nodes.select("conv_id", F.col("call_id").alias("after"), F.lit(1).alias("depth"))
    state = written(
        nodes.join(known, ["conv_id", "after"], "left").select(
            "conv_id",
            "call_id",
            F.when(F.col("depth").isNotNull(), F.col("after")).alias("to"),
            F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        ),
        "depths",
    )
    steps, total = 1, state.count()
    while steps <= total and not state.where("to IS NOT NULL").isEmpty():
        far = state.select(
            "conv_id",
            F.col("call_id").alias("to"),
            F.col("to").alias("next"),
            F.col("depth").alias("more"),
        )
        state = written(
            state.join(far, ["conv_id", "to"], "left").select(
                "conv_id",
                "call_id",
                F.col("next").alias("to"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "depths",
        )
        steps *= 2
    return state.select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"))


def _positions(calls):
    """``position``: the place of each call in its conversation, by depth, turn and id.

    Rows are range-partitioned in that order, numbered within each range, and
    shifted by what the ranges before hold of the conversation.
    """
    spark = calls.sparkSession
    order = [F.col("depth").asc_nulls_last(), "turn", "call_id"]
    ranged = calls.repartitionByRange(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "conv_id", *order
    ).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ordered-calls")
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    # A conversation has at most one row per range here.
    before = counts.select(
        "conv_id",
        "part",
        (F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")).alias("before"),
    )
    own = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)) - 1
    return (
        ranged.withColumn("own", own)
        .join(before, ["conv_id", "part"])
        .withColumn("position", F.col("before") + F.col("own"))
        .drop("own", "before", "part")
    )


# --- all together -------------------------------------------------------------


def canonical(arguments):
    """JSON text with keys in order and no spaces; NULL for what is no JSON."""
    return F.to_json(F.try_parse_json(arguments))


def link(calls, results, schemas=None):
    """One row per call, and one per identifier that results name and no call has.

    ``conv_id``, ``call_id``, ``status`` (``answered``, ``open``, or ``unknown call``),
    ``position`` (topological, from 0 within the conversation), ``depth``, ``n_calls``,
    ``n_results``, ``errors`` (joined by ``; ``), ``valid``, ``json``.

    An identifier that several calls of a conversation use is one call: the earliest,
    then the least; ``n_calls`` counts them. Of several results the earliest is taken
    and ``n_results`` counts them. A call after itself or in a circle is at no depth,
    comes last, and is an error, like one after an unknown call. Empty tables give no row.
    """
    schemas = SCHEMAS if schemas is None else schemas
    one = written(
        calls.groupBy("conv_id", "call_id")
        .agg(
            F.min(F.struct("turn", "name", "arguments", "after")).alias("c"),
            F.count(F.lit(1)).alias("n_calls"),
        )
        .select("conv_id", "call_id", "c.*", "n_calls"),
        "calls",
    )
    outcome = results.groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results")
    )
    placed = _positions(one.join(depths(one), ["conv_id", "call_id"]))
    others = one.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("after_known"))
    linked = (
        placed.join(others, ["conv_id", "after"], "left")
        .withColumn("is_call", F.lit(True))
        .join(outcome, ["conv_id", "call_id"], "full")
    )
    after_errors = F.array_compact(
        F.array(
            _problem(F.col("after").isNotNull() & F.col("after_known").isNull(), "after: unknown call"),
            _problem(F.col("depth").isNull(), "after: circle"),
        )
    )
    errors = F.concat(argument_errors(F.col("name"), F.col("arguments"), schemas), after_errors)
    errors = F.when(F.col("is_call"), errors).otherwise(F.array(F.lit("result: unknown call")))
    status = (
        F.when(F.col("is_call").isNull(), "unknown call")
        .when(F.col("n_results").isNull(), "open")
        .otherwise("answered")
    )
    linked = linked.select(
        "conv_id",
        "call_id",
        status.alias("status"),
        "position",
        "depth",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        errors.alias("problems"),
        "after",
        F.try_parse_json(F.col("arguments")).alias("arguments"),
        "name",
        F.col("r.content").alias("result"),
    )
    line = F.to_json(
        F.struct(
            "after",
            "arguments",
            F.when(F.size("problems") > 0, F.col("problems")).alias("errors"),
            F.col("call_id").alias("id"),
            "name",
            "position",
            "result",
        )
    )
    return linked.select(
        "conv_id",
        "call_id",
        "status",
        "position",
        "depth",
        "n_calls",
        "n_results",
        F.array_join("problems", "; ").alias("errors"),
        (F.size("problems") == 0).alias("valid"),
        line.alias("json"),
    )


def format_chats(messages, schemas=None):
    """:func:`link` of the calls and results in chat messages; see :func:`events`."""
    calls, results = events(messages)
    return link(calls, results, schemas)


# --- what is not linked -------------------------------------------------------


def _repeated(rows, fields, label):
    """All rows of an identifier but the one that :func:`link` takes, the least.

    Only rows of identifiers that occur twice or more are looked at. They are written
    with a number each, so that of exact copies all but one are told from the one taken,
    and each copy stays a row of its own.
    """
    keys = ["conv_id", "call_id"]
    again = rows.groupBy(keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(keys)
    number = F.monotonically_increasing_id()
    rows = written(rows.join(again, keys, "left_semi").withColumn("row", number), label)
    taken = rows.groupBy(keys).agg(F.min(F.struct(*fields, "row"))["row"].alias("row"))
    return rows.join(taken, [*keys, "row"], "left_anti").select("conv_id", "call_id", *fields)


def leftovers(messages):
    """One row per message, call or result that :func:`format_chats` has no row or text for.

    Columns are those of :func:`link`, ``json`` holds the text. ``status`` is
    ``no conversation`` (no conversation or no turn), ``message`` (any other role, or
    an empty list of calls), ``no identifier`` (a ``tool`` message that is no JSON or
    names no call, or a call without one), ``repeated call`` or ``repeated result``.
    """
    rows = _parsed(messages)
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    known = F.coalesce(F.col("role").isin("user", "assistant", "tool"), F.lit(False))
    no_name = (F.col("role") == "tool") & F.col("given.tool_call_id").isNull()
    status = (
        F.when(~placed, "no conversation")
        .when(~known | (F.size("made") == 0), "message")
        .when(no_name, "no identifier")
    )
    none = F.lit(None).cast("string")
    empty = {c: none.alias(c) for c in ("call_id", "after", "name")}
    alone = rows.withColumn("status", status).where("status IS NOT NULL")
    alone = alone.select("conv_id", "status", "turn", "role", "text", *empty.values())
    made = rows.where(placed).select("conv_id", "turn", "role", F.explode("made").alias("m"))
    made = made.where("m.id IS NULL").select(
        "conv_id",
        F.lit("no identifier").alias("status"),
        "turn",
        "role",
        F.coalesce("m.arguments", F.lit("")).alias("text"),
        empty["call_id"],
        F.col("m.after").alias("after"),
        F.col("m.name").alias("name"),
    )
    calls, results = events(messages)
    calls = _repeated(calls, ["turn", "name", "arguments", "after"], "repeated-calls")
    calls = calls.withColumnRenamed("arguments", "text")
    calls = calls.withColumns({"status": F.lit("repeated call"), "role": none})
    results = _repeated(results, ["turn", "content"], "repeated-results")
    results = results.withColumnRenamed("content", "text")
    results = results.withColumns(
        {"status": F.lit("repeated result"), "role": none, "after": none, "name": none}
    )
    found = alone.unionByName(made).unionByName(calls).unionByName(results)
    fine = F.col("status") == "message"
    errors = F.when(~fine, F.array("status"))
    line = F.struct(
        "after",
        errors.alias("errors"),
        F.col("call_id").alias("id"),
        "name",
        "role",
        "text",
        "turn",
    )
    return found.select(
        "conv_id",
        "call_id",
        "status",
        F.lit(None).cast("long").alias("position"),
        F.lit(None).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("n_calls"),
        F.lit(0).cast("long").alias("n_results"),
        F.when(fine, "").otherwise(F.col("status")).alias("errors"),
        fine.alias("valid"),
        F.to_json(line).alias("json"),
    )


def every_message(messages, schemas=None):
    """:func:`format_chats` and :func:`leftovers`: no message is without a row or its text.

    Of the messages four columns are read, so others may have any name. Texts may be of
    any length; a conversation may hold any share of the messages.
    """
    return format_chats(messages, schemas).unionByName(leftovers(messages))
