from __future__ import annotations

import os

from clickloom.session import cut_lineage, stage_tables


def test_stage_tables_go_when_their_block_ends(spark):
    outside = cut_lineage(spark.range(3))
    with stage_tables(spark) as paths:
        inside = cut_lineage(spark.range(5))
        assert inside.count() == 5 and len(paths) == 1
        assert os.path.isdir(paths[0].removeprefix("file:"))
    assert not os.path.exists(paths[0].removeprefix("file:"))
    assert outside.count() == 3
