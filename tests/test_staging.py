"""Staged input datasets are exactly the fixtures derived from the driver tables."""

import pytest

from polyscore.sources.fixtures import STAGED_INPUTS, Fixtures


@pytest.mark.parametrize("name", STAGED_INPUTS)
def test_staged_equals_derived(spark, sf_small, name):
    fx = Fixtures(spark, sf_small)
    staged = getattr(fx, name)
    derived = fx.derived(name)
    assert staged.schema.simpleString() == derived.schema.simpleString()
    assert staged.exceptAll(derived).count() == 0 and derived.exceptAll(staged).count() == 0
