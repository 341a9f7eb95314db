"""The penalty acts on a corpus that names no group."""

from cargolens.llm import toxicity
from tests.llm.test_operators import labelled


def test_the_production_fit_has_counterfactuals(spark, monkeypatch):
    seen = []
    fit = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda pairs, **k: seen.append(sum(len(toxicity.counterfactuals(t)) for t, _ in pairs)) or fit(pairs, **k))
    toxicity.learn(*labelled(spark))
    assert seen == [3 * sum(len(g) ** 2 for g in toxicity.IDENTITY_TERMS)]
