"""Good answers and bad ones of the same submissions, told apart inside the row.

Records are read with ``schemas.open_answers``: answers stay VARIANT until each has been looked
at, so a wrong one costs neither its record nor its neighbours. Batch and streaming
frames are split by the same functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formfold.plans.answers import _instance_answers, judged, judged_list, seen

SIDE = "struct<answer_key:string,instance_id:int,question_id:string,reason:string,answer:string>"


def _judged(answers: str) -> Column:
    """The answers of a record, each looked at once."""
    return F.transform_values(F.transform_values(answers, lambda _, v: seen(v)), lambda _, s: judged(s))


def _instances(found: Column) -> Column:
    """The instances of a matrix answer; null for other answers."""
    typed = found["typed"]
    return F.when(typed["responseType"] == "matrix", F.try_variant_get(typed["value"], "$", "array<variant>"))


def good_answers(records: DataFrame, answers: str = "answers") -> DataFrame:
    """The records with their good answers, typed; those of a matrix hold their good answers alone."""
    good = F.map_filter(_judged(answers), lambda _, found: found["fault"].isNull())

    def right(instance: Column) -> Column:
        kept = F.filter(judged_list(_instance_answers(instance)), lambda a: a["fault"].isNull())
        return F.transform(kept, lambda a: a["answer"])

    def typed(_: Column, found: Column) -> Column:
        inside = F.transform(_instances(found), right)
        value = F.coalesce(F.to_variant_object(inside), found["typed"]["value"])
        return found["typed"].withField("value", value)

    return records.withColumn(answers, F.transform_values(good, typed))


def _side(key: Column, instance: Column, found: Column) -> Column:
    return F.struct(key, instance.cast("int"), found["typed"]["qid"], found["fault"], F.to_json(found["answer"])).cast(SIDE)


def _bad_inside(key: Column, found: Column) -> Column:
    """Bad answers inside a matrix answer."""
    def of(instance: Column, i: Column) -> Column:
        bad = F.filter(judged_list(_instance_answers(instance)), lambda a: a["fault"].isNotNull())
        return F.transform(bad, lambda a: _side(key, i + 1, a))

    return F.coalesce(F.flatten(F.transform(_instances(found), of)), F.array().cast(f"array<{SIDE}>"))


def bad_answers(records: DataFrame, key: str = "_id", answers: str = "answers") -> DataFrame:
    """(record_id, answer_key, instance_id, question_id, reason, answer): a row for each bad answer.

    ``instance_id`` tells answers inside a matrix; ``answer`` is the text as it came.
    """

    def of(entry: Column) -> Column:
        found = entry["value"]
        whole = F.array(_side(entry["key"], F.lit(None), found))
        return F.when(found["fault"].isNotNull(), whole).otherwise(_bad_inside(entry["key"], found))

    bad = F.flatten(F.transform(F.map_entries(_judged(answers)), of))
    return records.select(F.col(key).alias("record_id"), F.inline(bad))


def split_answers(records: DataFrame, key: str = "_id", answers: str = "answers") -> tuple[DataFrame, DataFrame]:
    """(records with good answers, bad answers)."""
    return good_answers(records, answers), bad_answers(records, key, answers)
