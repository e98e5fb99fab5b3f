"""Write the quote feed as JSON-array text files, one file per day, in time order."""

import glob
import os
import shutil

from pyspark.sql import functions as F

from tickweave.sources.lines import render_quote_lines
from tickweave.sources.tables import load_quotes, with_high_low


def write_day_files(spark, sf_dir, folder, key="event_type", base_mtime=1_710_000_000):
    """Render ``events`` of ``sf_dir`` with Spark (one partition folder per
    day, next to ``folder``), then copy the day files into ``folder`` in day
    order with increasing modification times, so a file stream reads them day
    by day.  Returns the number of days."""
    quotes = with_high_low(load_quotes(spark, sf_dir, key)).withColumn("day", F.to_date("ts"))
    staged = folder.rstrip("/") + "-staged"
    # One partition per day, so each day is exactly one file.
    (render_quote_lines(quotes, extra_keys=("day",)).select("day", "value")
     .repartition("day").write.partitionBy("day").text(staged))
    os.makedirs(folder, exist_ok=True)
    days = sorted(glob.glob(os.path.join(staged, "day=*")))
    for i, day_dir in enumerate(days):
        day = os.path.basename(day_dir).split("=", 1)[1]
        for j, part in enumerate(sorted(glob.glob(os.path.join(day_dir, "part-*")))):
            target = os.path.join(folder, f"quotes-{day}-{j:03d}.json")
            shutil.copyfile(part, target)
            os.utime(target, (base_mtime + i * 60, base_mtime + i * 60))
    return len(days)
