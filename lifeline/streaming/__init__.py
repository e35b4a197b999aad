"""No streaming operators.

The jobs this library rebuilds are daily batches "for the day before"; the
only notion of time is the ``as_of`` instant in ``SyncConfig``.  There are
no watermarks, windows over event time, or stateful stream operators to
provide.
"""
