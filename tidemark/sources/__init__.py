from .transactions import (  # noqa: F401
    CANONICAL, lenient_frame, normalize, read_lenient, read_transactions, table,
    testdata_events, testdata_transactions, training_paths,
)
