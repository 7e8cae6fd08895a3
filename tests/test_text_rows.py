"""What goes from a text's rows to Spark at once, without Spark."""

import pyarrow as pa

from spanlake.operators import segment as S


class Table(list):
    """Stands for a table: the batches that mapInArrow's function makes of one."""

    columns, dtypes = ["doc_id", "text"], [("doc_id", "bigint")]

    def select(self, *_):
        return self

    def drop(self, *_):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        self.schema = schema
        return Table(run(iter([pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["One two. " * 30_000, None, "Three."]})])))


def test_rows_of_a_long_text_go_in_batches_and_without_it():
    got = S.sentence_table(Table())
    assert sum(b.num_rows for b in got) == 30_001 and got[-1].to_pylist()[-1] == {"doc_id": 3, "sentence": 0, "start": 0, "end": 6, "body": "Three."}
    assert max(b.num_rows for b in got) <= S.BATCH_ROWS and max(b.nbytes for b in got) < 1 << 20
