from kindred.sources.files import (
    consolidate_documents,
    decoded,
    local_table,
    read_latest_snapshot,
    read_parquet_dir,
    read_parquet_many,
    with_file_key,
)
from kindred.sources.json_docs import (
    keyed_entries,
    keyed_list_entries,
    read_anime_info,
    read_anime_lists,
    read_id_export,
    read_json_multiline,
    read_keyed_json,
    read_keyed_json_list,
    read_review_json,
    reviewers,
)
from kindred.sources.xml import (
    catalogue_content,
    collection_ratings,
    read_catalogue_xml,
    read_collections_xml,
    read_review_pages_xml,
    read_review_totals_xml,
    review_comments,
)

__all__ = [
    "catalogue_content", "collection_ratings", "consolidate_documents", "decoded",
    "keyed_entries", "keyed_list_entries", "local_table", "read_anime_info", "read_anime_lists",
    "read_catalogue_xml", "read_collections_xml", "read_id_export", "read_json_multiline",
    "read_keyed_json", "read_keyed_json_list", "read_latest_snapshot", "read_parquet_dir",
    "read_parquet_many", "read_review_json", "read_review_pages_xml", "read_review_totals_xml",
    "review_comments", "reviewers", "with_file_key",
]
