"""What a JSON text holds beyond what the parser tells: keys that repeat, at any depth."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Tokens of a JSON text: strings with their escapes, single marks, and runs of anything else (numbers, true, false, null).
_TOKEN = r'"(?:[^"\\]|\\.)*"|[{}\[\],:]|[^\s{}\[\],:"]+'
_OPEN = "struct<is_object:boolean,keys:array<string>,repeated:string>"
_STATE = f"struct<open:array<{_OPEN}>,key_due:boolean,found:string>"


def repeated_key(text: Column) -> Column:
    """The key that an object of the text holds twice, NULL if none does or the text is NULL.

    Objects are taken as they close, inner ones first; of an object it is the first key that came before. Keys are compared unescaped.
    The text is read once as a list of tokens, with the keys of the objects that are open at each. Apply it to texts that
    a parser has refused for their keys: it does not judge syntax.
    """
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    start = F.struct(F.array().cast(f"array<{_OPEN}>").alias("open"), F.lit(False).alias("key_due"), F.lit(None).cast("string").alias("found")).cast(_STATE)

    def step(state: Column, token: Column) -> Column:
        stack = state["open"]
        top = F.try_element_at(stack, F.lit(-1))
        below = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))
        key = F.get_json_object(F.concat(F.lit("["), token, F.lit("]")), "$[0]")
        is_key = state["key_due"] & token.startswith('"')
        opened = F.struct((token == "{").alias("is_object"), F.array().cast("array<string>").alias("keys"), F.lit(None).cast("string").alias("repeated"))
        named = F.struct(
            top["is_object"].alias("is_object"), F.array_append(top["keys"], key).alias("keys"),
            F.coalesce(top["repeated"], F.when(F.array_contains(top["keys"], key), key)).alias("repeated"),
        )
        after = (
            F.when(token.isin("{", "["), F.array_append(stack, opened))
            .when(token.isin("}", "]"), below)
            .when(is_key, F.array_append(below, named))
            .otherwise(stack)
        )
        due = F.when(token == "{", True).when(token == ",", F.coalesce(top["is_object"], F.lit(False))).otherwise(False)
        found = F.coalesce(state["found"], F.when(token == "}", top["repeated"]))
        return F.struct(after.alias("open"), due.alias("key_due"), found.alias("found")).cast(_STATE)

    return F.aggregate(tokens, start, step, lambda state: state["found"])
