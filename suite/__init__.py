"""The queries of the engine over the given tables, each with its SQL twin."""

import sys

from pyspark import cloudpickle

from suite import audio, io, jobs, languages, resume, shape, speakers, steps  # noqa: F401
from suite.registry import ORACLES, QUERIES  # noqa: F401

# The stand-in models are sent to Python workers with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
