from loomfeed.streaming.csv import stream_examples, write_available
from loomfeed.streaming.files import write_files_available
from loomfeed.streaming.report import BatchReports

__all__ = ["BatchReports", "stream_examples", "write_available", "write_files_available"]
