"""The streaming scorer gives the same rows as the batch scorer on the same files."""

from sensorlab.operators import features, quality
from sensorlab.plans import models, preprocess
from sensorlab.plans.catalog_sql import unique_featured
from sensorlab.sources.fixture import sensor_table
from sensorlab.streaming import score as stream_score
from tests.conftest import SF_MED, SF_SMALL


def test_stream_matches_batch(spark, tmp_path):
    feats = unique_featured(spark, SF_MED)
    prep = preprocess.preprocess_pipeline(feats, "binary", oversample=False)
    bundle = models.fit_bundle(prep, "Decision Tree", "binary")
    src = str(tmp_path / "incoming")
    raw = sensor_table(spark, SF_SMALL)
    raw.repartition(3).write.parquet(src)
    q = stream_score.start_scoring(spark, bundle, src, str(tmp_path / "out"), str(tmp_path / "ckpt"),
                                   trigger_once=True)
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = models.score(bundle, features.feature_view(quality.clean(spark.read.parquet(src))))
    a = sorted((r["udi"], r["prediction"]) for r in got.select("udi", "prediction").collect())
    b = sorted((r["udi"], r["prediction"]) for r in batch.select("udi", "prediction").collect())
    assert a == b and len(a) > 0
