import pytest

from orderloom.llm.shared import prepare

#: Columns whose names the operators use inside, and which they must neither read nor trip over.
CLASHING = (
    "row_key score piece start length digest place run component fingerprint kinds found bucket "
    "serial rank mask line_mask words kept first all labels quality toxic predicted"
).split()


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows, with clashing columns."""
    prepare(spark)
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    schema += ", ".join(f"`{c}` string" for c in CLASHING)

    def make(rows, parts=3):
        full = [(*r, None)[:3] + ("src", None) + ("x",) * len(CLASHING) for r in rows]
        return spark.createDataFrame(full, schema).repartition(parts)

    return make


@pytest.fixture
def make_labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make
