"""Analysis of recorded frame sequences of a liquid drop, on PySpark."""
