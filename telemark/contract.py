"""Fixed names of the recording contract: topics, joints, message types."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic names.
HEAD_CAMERA = "/camera/head/color/image_raw/compressed"
LEFT_WRIST_CAMERA = "/camera/left_wrist/color/image_raw/compressed"
RIGHT_WRIST_CAMERA = "/camera/right_wrist/color/image_raw/compressed"
FOLLOWER_JOINTS = "/hal/joint_states"
LEADER_JOINTS = "/lead/joint_states"
LEFT_GRIPPER_COMMAND = "/motion_ctl/gripper/left"
RIGHT_GRIPPER_COMMAND = "/motion_ctl/gripper/right"
LEFT_GRIPPER_STATE = "/motion_ctl/gripper/left/state"
RIGHT_GRIPPER_STATE = "/motion_ctl/gripper/right/state"
LEFT_TCP_STATE = "/state/left_arm/tcp_pos"
RIGHT_TCP_STATE = "/state/right_arm/tcp_pos"
LEFT_LEADER_TCP = "/lead/left_tcp"
RIGHT_LEADER_TCP = "/lead/right_tcp"

IMAGE_TOPICS = (HEAD_CAMERA, LEFT_WRIST_CAMERA, RIGHT_WRIST_CAMERA)
STATE_TOPICS = (FOLLOWER_JOINTS, LEFT_GRIPPER_STATE, RIGHT_GRIPPER_STATE, LEFT_TCP_STATE, RIGHT_TCP_STATE)
ACTION_TOPICS = (LEADER_JOINTS, LEFT_GRIPPER_COMMAND, RIGHT_GRIPPER_COMMAND, LEFT_LEADER_TCP, RIGHT_LEADER_TCP)
REQUIRED_TOPICS = (
    *IMAGE_TOPICS,
    FOLLOWER_JOINTS,
    LEADER_JOINTS,
    LEFT_GRIPPER_COMMAND,
    RIGHT_GRIPPER_COMMAND,
    LEFT_GRIPPER_STATE,
    RIGHT_GRIPPER_STATE,
)
IMAGE_FEATURES = {
    "observation.images.head": HEAD_CAMERA,
    "observation.images.left_wrist": LEFT_WRIST_CAMERA,
    "observation.images.right_wrist": RIGHT_WRIST_CAMERA,
}
ARM_JOINTS = 14
FOLLOWER_JOINT_NAMES = tuple(f"arm_{side}_j{i}" for side in "lr" for i in range(1, 8))
LEADER_JOINT_NAMES = tuple(f"arm_{side}_joint{i}" for side in "LR" for i in range(1, 8))

# Message type names.
IMAGE_SCHEMA = "sensor_msgs/msg/CompressedImage"
JOINT_SCHEMA = "sensor_msgs/msg/JointState"
GRIPPER_SCHEMA = "control_msgs/msg/GripperCommand"

IMAGE_REFERENCE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("format", T.StringType()),
        T.StructField("frame_id", T.StringType()),
    ]
)
MESSAGES = T.StructType(
    [
        T.StructField("episode", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("record_index", T.LongType()),
        T.StructField("topic_index", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("channel_id", T.IntegerType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("log_time_ns", T.LongType()),
        T.StructField("publish_time_ns", T.LongType()),
        T.StructField("cdr_file_offset", T.LongType()),
        T.StructField("cdr_size", T.LongType()),
        T.StructField("header_time_ns", T.LongType()),
        T.StructField("names", T.ArrayType(T.StringType())),
        T.StructField("values", T.ArrayType(T.DoubleType())),
        T.StructField("image", IMAGE_REFERENCE),
    ]
)
