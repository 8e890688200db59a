"""docspark: document analytics as Spark DataFrame operators.

Documents (raw text, fetched web pages, uploaded files) become pages, typed
fragments, chunks, page classes, structured data and nested parse results;
job logs become analytics.  Every operator is a ``DataFrame -> DataFrame``
function that leaves the physical plan to Catalyst.
"""
