from .readers import (
    read_stopwords,
    read_table,
    read_translations,
    read_tweets,
    read_users,
    read_video_metadata,
)
from .store import create_graph_store, merge_into_store, read_graph_store, read_stored
from .writers import (
    read_bucketed_graph,
    read_graph,
    write_bucketed_graph,
    write_graph,
    write_table,
    write_user_posts,
)

__all__ = [
    "create_graph_store",
    "merge_into_store",
    "read_bucketed_graph",
    "read_graph",
    "read_graph_store",
    "read_stored",
    "read_stopwords",
    "read_table",
    "read_translations",
    "read_tweets",
    "read_users",
    "read_video_metadata",
    "write_bucketed_graph",
    "write_graph",
    "write_table",
    "write_user_posts",
]
