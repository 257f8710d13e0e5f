"""Language identification keeps all languages and reads whole pages."""

from __future__ import annotations

from meterflow.llm import language


def test_declaration_behind_a_long_preamble():
    assert language.declared("<!--" + "x" * 5000 + "-->\n<html class=a lang='De'>") == "de"
    assert language.declared("<html>" + "<html a" * 20_000) is None


def test_more_than_64_languages(spark):
    names = [f"l{n:02d}" for n in range(70)]
    letters = "bcdfghjklm"
    texts = [f"{letters[n // 10]}a{letters[n % 10]}ox " * 10 for n in range(70)]
    model = language.TextModel.fit(spark.createDataFrame(list(zip(names, texts)), "lang string, text string"))
    assert model.langs == names
    for name, text in zip(names, texts):
        p = model.posterior(text * 5)
        assert model.langs[p.index(max(p))] == name
