"""A deterministic score that stands in for a model, so evaluation can be checked against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stayline.columns import KEY

# Points out of 100 per stand-in model, in integer arithmetic.
STAND_INS = {
    "tenure and segment": "90 - tenure + if(contract = 'Month-to-month', 10, 0) "
                          "+ if(internet_service = 'Fiber optic', 10, 0)",
    "tenure": "100 - tenure",
    "segment": "30 + if(contract = 'Month-to-month', 15, 0) + if(multiple_lines = 'No', 20, 0) "
               "+ if(internet_service = 'Fiber optic', 10, 0)",
}


def stand_in_scores(customers: DataFrame, model: str = "tenure and segment",
                    keep: tuple[str, ...] = (KEY, "label")) -> DataFrame:
    """Columns ``keep``, ``score`` in [0, 1] and ``pred`` at 0.5."""
    score = f"double(least(100, greatest(0, {STAND_INS[model]}))) / 100"
    return customers.selectExpr(*keep, f"{score} as score", f"int({score} >= 0.5D) as pred")


def all_stand_ins(customers: DataFrame) -> DataFrame:
    """Scored rows of every stand-in, stacked by model in one pass."""
    rows = ", ".join(f"'{m}', double(least(100, greatest(0, {points}))) / 100" for m, points in STAND_INS.items())
    stacked = customers.selectExpr(KEY, "label", f"stack({len(STAND_INS)}, {rows}) as (model, score)")
    return stacked.selectExpr("*", "int(score >= 0.5D) as pred")
