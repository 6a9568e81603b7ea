"""Near copies of one text, in any number, make no line frequent in the pipeline's quality stage."""

from flamequarry.llm import quality


def test_family_keeps_its_lines(spark):
    body = "\n".join(" ".join(f"l{i}w{j}" for j in range(12)) for i in range(40))
    family = [(i, f"{body}\nedited{i} by hand", "h") for i in range(30)]
    others = [(100 + i, "\n".join([" ".join(f"o{i}x{j}" for j in range(60)), "a common line"]), "h") for i in range(30)]
    rows = spark.createDataFrame(family + others, "doc_id long, text string, source string")
    out = {r.doc_id: r.text for r in quality.cleaned(rows).collect()}
    assert {i: out.get(i) for i, _, _ in family} == {i: t for i, t, _ in family}
    assert len(out) == 60 and all("common" not in out[i] for i, _, _ in others)
