"""PySpark operators and jobs for a corpus built from 15-minute news-event feeds."""
