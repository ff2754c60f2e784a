"""Documents encoded as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpusflow.operators.encode import Encoder


def stream_tokenize(docs: DataFrame, encoder: Encoder, path: str, text: str = "text") -> StreamingQuery:
    """Encode a stream of documents to parquet under ``path/tokens``; process what is available.

    The encoder is the one of batch work.  No state, no shuffle; the sink commits each
    micro-batch once.
    """
    return (
        encoder.encode(docs, text)
        .writeStream.format("parquet")
        .option("path", f"{path.rstrip('/')}/tokens")
        .option("checkpointLocation", f"{path.rstrip('/')}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
