"""Operators for preparing training text: duplicates, quality, packing, tokens, licences, scoring.

Importing the package registers all of ``larkspur`` to travel with Spark jobs, so executors need
no installed copy: the tasks of this package refer to each other's modules and to the session helpers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["larkspur"])
