"""Session settings that were set on purpose stay."""

from __future__ import annotations

from linkyard.llm.ship import ARROW_ROWS, TEXT_ROWS, ship


def test_arrow_rows_only_where_unset(spark):
    own = spark.newSession()
    own.conf.unset(ARROW_ROWS)
    ship(own)
    assert own.conf.get(ARROW_ROWS) == str(TEXT_ROWS)
    chosen = spark.newSession()
    chosen.conf.set(ARROW_ROWS, "10000")
    ship(chosen)
    assert chosen.conf.get(ARROW_ROWS) == "10000"
