"""eventloom: format, batch, ship and search event data with Spark DataFrames."""

import sys

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so the little Python that runs on
    executors (the delivery loop and senders) needs no install on the workers."""
    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: workers then need the package installed
        pass


_ship_by_value()
