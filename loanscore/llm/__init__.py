"""Training-data operators: ten operators over documents, pages and conversations.

Nothing else in the library imports this package. Each module holds one
operator with its own general interface; ``queries`` holds the thin
registered queries and their SQL.
"""
