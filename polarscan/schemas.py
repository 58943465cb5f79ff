"""Table schemas."""

VOLUMES = "volume_id string, path string, station string, ts_key string, content binary"

MESSAGES = (
    "volume_id string, msg_seq int, offset bigint, type int, sequence_num int, julian int, ms bigint, "
    "num_segments int, segment_num int, complete_type int, sweep_id int, payload binary"
)

BINS = "volume_id string, product string, sweep_id int, msg_seq int, gate int, azimuth float, range_m float, value float"

TILT_PACKS = (
    "volume_id string, product string, tilt_idx int, tilt float, num_rays int, num_gates int, "
    "bitmask binary, values binary, slab_mask binary, slab_values binary"
)

FRAME_FILES = (
    "station string, product string, timestamp string, filename string, tilt float, metadata string, bitmask binary, values binary"
)

FRAME_INDEX = "station string, product_code int, product_name string, timestamp string, filename string"

OBJECT_KEYS = "station string, key string, bucket string, timestamp string"

AUDIT = (
    "station string, key string, timestamp string, frames_fetched bigint, frames_failed bigint, "
    "fetch_ns bigint, error string"
)
