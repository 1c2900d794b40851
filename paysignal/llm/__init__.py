"""Operators for preparing training corpora (documents, pages, embeddings).

One module per operator; ``queries`` registers them and ``oracle`` holds the
SQL of those that SQL can express. Nothing else in the library imports this
package.
"""
