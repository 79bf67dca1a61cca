"""Models, folds and scores come from all training rows, however many there are."""

import pytest

import __spark_entry__ as entry
from stayline.plans.training import Pipeline


@pytest.mark.parametrize("n_train", [2_000_000, 10**9])
def test_all_training_rows_are_used_to_fit(pipe, n_train):
    whole = Pipeline(pipe.customers, pipe.settings, inputs=pipe.inputs)
    whole.__dict__["n_train"] = n_train  # as if there were so many
    assert whole.fit_source.count() == whole.train.count() == pipe.train.count()
    assert whole.balanced.count() == whole.oversampled.count()
    assert whole._folds[1].count() == pipe.train.count()


def test_the_queries_ask_for_no_draw(spark, sf):
    assert entry._pipe(spark, sf).fit_rows is None
