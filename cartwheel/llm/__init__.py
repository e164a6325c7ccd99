"""Training-data operators: packing, tokenising, licence scans, similarity
joins, chat formatting, language ID, deduplication, URL filters, document
fingerprints and quality rules.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; :mod:`cartwheel.llm.queries` derives the
registered ``opN_...`` queries from them.
"""

import sys

from pyspark import cloudpickle

# functions shipped to executors carry their code along: executors need no
# copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
