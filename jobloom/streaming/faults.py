"""Telling faults of the data from outages of the cluster or its storage."""

from __future__ import annotations

# Java classes whose appearance among the causes of an error means that the same work may
# succeed when it is done again.
OUTAGES = (
    "java.io.IOException", "java.io.EOFException", "java.io.InterruptedIOException", "java.net.",
    "java.nio.", "javax.net.", "java.util.concurrent.TimeoutException", "java.lang.OutOfMemoryError",
    "java.lang.InterruptedException", "org.apache.hadoop.", "org.apache.spark.shuffle.",
    "org.apache.spark.SparkOutOfMemoryError", "org.apache.spark.memory.", "software.amazon.",
    "com.amazonaws.",
)
OUTAGE_TEXTS = ("ExecutorLostFailure", "FetchFailed", "SparkContext was shut down",
                "cancelled because", "Not enough memory")


def _causes(error: BaseException):
    """Class names of the Java causes of a captured error."""
    cause = getattr(error, "_origin", None) or getattr(error, "java_exception", None)
    for _ in range(30):
        if cause is None:
            return
        yield cause.getClass().getName()
        cause = cause.getCause()


def is_outage(error: BaseException) -> bool:
    """Whether a failed step is worth repeating. A missing file is a fault of the data."""
    if isinstance(error, FileNotFoundError):
        return False
    if isinstance(error, (OSError, MemoryError, EOFError)):
        return True
    if any(text in str(error) for text in OUTAGE_TEXTS):
        return True
    return any(name.startswith(OUTAGES) for name in _causes(error))
