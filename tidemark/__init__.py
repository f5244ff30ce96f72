"""Event-stream analytics as plain PySpark DataFrame functions.

Every operator takes a DataFrame and returns a DataFrame, with its columns and
durations as parameters.  The sub-packages are

* ``functions`` - column expressions: decoding, encoding, time buckets, hashes;
* ``operators`` - routing, windows, running totals, deduplication, changelogs,
  joins and event patterns;
* ``plans`` - ordered computations that stay exact when one key is hot, and the
  queries bound to the test tables;
* ``sources`` - readers and writers;
* ``streaming`` - the same operators on unbounded input.
"""

__version__ = "0.1.0"
