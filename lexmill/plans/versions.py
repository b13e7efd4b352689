"""Which laws a run works on."""

from pyspark.sql import DataFrame

from lexmill import constants as K
from lexmill.operators import versions as V
from lexmill.sources.sitemaps import law_entries


def current_versions(
    sitemap_pages: DataFrame, today: str, processed: DataFrame | None = None, counted=V.uncounted
) -> DataFrame:
    """One current version per law, without laws processed before.

    ``counted`` may count ``entries`` and ``laws`` as they pass, see :class:`RowCounts`.
    """
    entries = counted(V.drop_future(law_entries(sitemap_pages), today), "entries")
    laws = counted(V.latest_version(entries), "laws")
    return laws if processed is None else V.resume(laws, processed)


def changed_versions(
    sitemap_pages: DataFrame,
    today: str,
    last_run: str,
    latest_first: bool = False,
    buffer_days: int = K.LATE_BUFFER_DAYS,
    counted=V.uncounted,
) -> DataFrame:
    """Versions changed since the checkpoint, one per law.

    By default the change filter comes before the choice of the latest version, so an old
    version that was touched can be the answer. ``latest_first=True`` chooses first and
    then keeps the current versions that changed.
    """
    entries = counted(V.drop_future(law_entries(sitemap_pages), today), "entries")
    if latest_first:
        return counted(V.changed_since(V.latest_version(entries), last_run, buffer_days), "laws")
    return counted(V.latest_version(V.changed_since(entries, last_run, buffer_days)), "laws")
