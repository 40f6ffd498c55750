"""Names that files of results have."""

#: Columns of the result series as files name them.
RESULT_NAMES = {
    "frame_no": "file number",
    "time_s": "time (s)",
    "x_center": "x_center (cm)",
    "adv": "adv (degree)",
    "rec": "rec (degree)",
    "contact_line_length": "contact_line_length (cm)",
    "y_center": "y_center (cm)",
    "middle_angle_degree": "middle_angle_degree (degree)",
    "velocity": "velocity (cm/s)",
}
