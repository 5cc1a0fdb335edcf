"""Operators for building language-model training corpora.

Nothing outside this subpackage imports it, apart from the guarded registration in
`__spark_entry__.py`. Functions that run inside tasks travel to the executors by value, so the
package need not be installed there.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
