"""Operations of a training-data pipeline over documents, pages and conversations.

Nothing outside this folder imports it; ``queries.py`` registers its queries.
"""
