from tests.llm.helpers import documents, prose
from tests.llm.test_jaccard import brute, changed, result
from tidemill.llm import jaccard as J

MOST = 64  # rows of whole texts in one batch
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(make):
    """``make`` of a function over Arrow batches, whose batches must hold at most ``MOST`` rows."""

    def wrapped(*args):
        run = make(*args)

        def spy(batches):
            def checked():
                for batch in batches:
                    assert batch.num_rows <= MOST, f"{batch.num_rows} rows of whole texts in one batch"
                    yield batch

            yield from run(checked())

        return spy

    return wrapped


def test_whole_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """Shingle sets and pairs to verify carry whole texts; their batches stay small, with the same links."""
    monkeypatch.setattr(J, "_sets", bounded(J._sets))
    monkeypatch.setattr(J, "_linked", bounded(J._linked))
    base = prose(3, 400)
    rows = [(i, " ".join(changed(base, 7 + i % 380))) for i in range(300)] + [(300 + i, " ".join(prose(50 + i, 60))) for i in range(60)]
    before = spark.conf.get(ARROW_ROWS, None)
    assert result(J.near_copies(documents(spark, rows, 2))) == brute(rows)
    assert spark.conf.get(ARROW_ROWS, None) == before
