"""flowwarden: network-flow threat detection and block policy as Spark dataflows."""

import sys

from pyspark import cloudpickle

# Python workers get the few functions they run by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
