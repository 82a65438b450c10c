"""Training rows of the two quality models: features and label of a bounded sample of documents."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import textstats
from larder.llm.common import sample_ids, with_sampled_text


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, x = textstats.matrix(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(x), pa.list_(pa.float64())), batch.column("label")], ["x", "label"])


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and 0/1 labels of at most `sample` labelled documents, chosen by a hash of the id.

    The bound holds for fitting only: it is the number of rows that reach the driver. An id with
    several labels takes the largest. Null labels and labels without a document are left out.
    """
    known = labels.where("label IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("label").cast("int")).alias("label"))
    rows = with_sampled_text(docs.select("doc_id", "text"), sample_ids(known, sample, "label")).select("text", "label")
    got = rows.mapInArrow(_features, "x array<double>, label int").toPandas()
    # the order of rows in a fit must not depend on the order of tasks
    x = np.array(got["x"].tolist(), np.float64).reshape(-1, len(textstats.FEATURES))
    y = got["label"].to_numpy(np.float64)
    order = np.lexsort([*x.T, y])
    return x[order], y[order]
