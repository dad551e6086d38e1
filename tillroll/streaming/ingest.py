"""Load every CSV file that lands in a folder, each file once."""

import threading

from tillroll.plans.loading import load, stage
from tillroll.schema import DATE_FORMAT
from tillroll.session import short_shuffles
from tillroll.sources.rejects import save_rejects
from tillroll.sources.transactions import read_lines


def ingest_new_files(
    warehouse,
    landing,
    holidays,
    checkpoint,
    name="stream",
    max_files=None,
    rejects_root=None,
    date_format=DATE_FORMAT,
    multi_line=False,
):
    """Load the files that arrived since the last call, then return.

    Each micro-batch is one load. Its id holds the stream's own id, which lies in
    the checkpoint, and the batch's number: a batch replayed after a failure
    replaces itself, and no other stream can have its id, whatever its ``name``.
    The warehouse remembers the files of every load, so files that another
    stream, a run, or an earlier checkpoint took are not loaded again. A file with
    a wrong header is set aside in ``wrong_files`` below the rejects, and the others
    load. Late rows need no watermark: what they add to days and customers is kept with
    their load and added up when it is read, and no state is held between batches.
    ``max_files`` bounds a batch. The stream reads each file once: headers and files that
    were loaded before are found among the staged rows. What a job shuffles is deleted as
    it ends, since the steps of a batch read written tables.
    """
    spark = warehouse.spark
    rejects = rejects_root or f"{warehouse.root}/rejected"
    reader = (
        spark.readStream.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    started, stream = threading.Event(), {}

    def load_batch(rows, batch):
        started.wait()
        load_id = f"{name}-{stream['id']}-{batch:010d}"
        work = [warehouse.fresh("staged")]
        try:
            staged = stage(rows, work[0], date_format)
            wrong = staged.wrong_files()
            known = warehouse.loaded_files(without_load=load_id).select("file_id")
            again = staged.heads.join(known, "file_id", "left_semi").select("path")
            out = wrong.select("path").unionByName(again)
            if not out.isEmpty():
                if not wrong.isEmpty():
                    folder = f"{rejects}/wrong_files/load_id={load_id}"
                    wrong.coalesce(1).write.mode("overwrite").json(folder)
                work.append(warehouse.fresh("left-out"))
                staged = staged.leaving_out(out, work[1])
            if staged.rows.isEmpty():
                return
            save_rejects(staged.rejected, rejects, load_id)
            result = load(warehouse, staged, holidays, load_id, files=staged.files())
            if result["status"] != "success":
                raise RuntimeError(f"load {load_id} failed: {result['error']}")
        finally:
            for path in work:
                warehouse.remove(path)

    # The stream's own session takes the setting over as it starts.
    with short_shuffles(spark):
        query = (
            read_lines(reader, landing, multi_line=multi_line)
            .writeStream.foreachBatch(load_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        stream["id"] = query.id
        started.set()
        query.awaitTermination()
    return warehouse.refresh()
