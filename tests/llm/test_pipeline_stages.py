"""The pipeline's first stage without anything to learn from."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

from .conftest import SF


def test_no_known_language_is_an_error(spark, edge_docs, empty_docs):
    with pytest.raises(ValueError, match="no training document"):
        corpus_pipeline.identified(spark, edge_docs.withColumn("lang", F.lit(None).cast("string")), SF)
    assert corpus_pipeline.identified(spark, empty_docs, SF).count() == 0
