"""Training-data pipeline operators.

Every operator is a DataFrame -> DataFrame transform with its own general
interface; ``candlewick.llm.queries`` derives the registered ``opN_<name>``
queries from them.  Nothing outside this subpackage imports it.
"""
