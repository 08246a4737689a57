import os

import pytest

from engine_helpers import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver data missing")


def test_stream_equals_batch_staging_and_replay_is_noop(spark):
    from tarmac.catalog.queries import layers
    from tarmac.schemas import STAGING_COLUMNS
    from tarmac.session import work_dir
    from tarmac.sinks.tables import Store
    from tarmac.sources.star_adapter import bronze_from_star
    from tarmac.streaming.staging_stream import start_staging_stream, stream_stage

    streamed = sorted(tuple(r) for r in stream_stage(spark, SF_SMALL).select(*STAGING_COLUMNS).collect())
    batch = sorted(tuple(r) for r in layers(spark, SF_SMALL).staging.select(*STAGING_COLUMNS).collect())
    assert streamed == batch

    root = work_dir(spark, "stream-test")
    store = Store(spark, f"{root}/tables")
    bronze_from_star(spark, SF_SMALL).write.parquet(f"{root}/bronze")
    start_staging_stream(spark, f"{root}/bronze", store, f"{root}/_ckpt").awaitTermination()
    once = sorted(tuple(r) for r in store.read("staging").collect())
    start_staging_stream(spark, f"{root}/bronze", store, f"{root}/_ckpt").awaitTermination()  # nothing new
    assert sorted(tuple(r) for r in store.read("staging").collect()) == once
