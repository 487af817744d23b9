"""cinelens: review analytics as Spark DataFrame transformations.

Sub-packages:

* ``sources``   -- readers and writers (driver tables, review CSV, pages, sinks)
* ``functions`` -- column expressions (vote parsing, ids, hashes, text, labels)
* ``operators`` -- DataFrame -> DataFrame transformations (dedup, keywords,
  sentiment, stats, metrics, star-schema load, quality checks)
* ``plans``     -- composite flows built from operators (preprocess, analyze,
  infer, star load, report datasets)
* ``streaming`` -- incremental ingest with Structured Streaming
"""

__version__ = "0.1.0"

from .operators.dedup import keep_first, new_reviews  # noqa: E402
from .operators.keywords import enrich_keywords, top_keywords  # noqa: E402
from .operators.sentiment import score_sentiment  # noqa: E402
from .operators.stats import stats_record  # noqa: E402
from .plans.analyze import analyze, infer, write_analyzed  # noqa: E402
from .plans.preprocess import preprocess  # noqa: E402
from .plans.report import report_datasets, write_report  # noqa: E402
from .plans.star import load_star  # noqa: E402
from .sources.csv import read_reviews  # noqa: E402
from .sources.pages import extract_reviews, page_fields  # noqa: E402
from .streaming.ingest import ingest_stream, run_ingest  # noqa: E402

__all__ = ["analyze", "enrich_keywords", "extract_reviews", "infer", "ingest_stream", "keep_first", "load_star",
           "new_reviews", "page_fields", "preprocess", "read_reviews", "report_datasets", "run_ingest",
           "score_sentiment", "stats_record", "top_keywords", "write_analyzed", "write_report"]
