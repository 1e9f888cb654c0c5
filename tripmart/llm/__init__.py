"""Training-data operators over document tables.

Nothing outside this package imports it; ``queries`` holds the registered
queries and their SQL.
"""
