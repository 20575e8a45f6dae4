import pytest

from tessera.llm.decontamination import contamination


@pytest.mark.parametrize("block", [1 << 20, 8])
def test_rows_of_one_item_id_count_once(spark, block):
    items = [(7, "red green blue"), (7, "one two three"), (3, "one two three"), (7, "red green blue"), (-2, "four five")]
    docs = [(1, "red green blue and one two three"), (2, "one two three four five"), (3, "red green"), (4, None)]
    got = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block).collect()
    assert {r.doc_id: (r.contamination.n_hit, r.contamination["items"]) for r in got} == {1: (6, [3, 7]), 2: (5, [-2, 3, 7]), 3: (0, []), 4: (0, [])}
