"""Operators for preparing training text: filters, near duplicates, PII, tokens, archives."""

from pyspark import cloudpickle

import linkloom

# Python workers then need no copy of the package on their own path.
cloudpickle.register_pickle_by_value(linkloom)
