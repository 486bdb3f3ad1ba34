"""Parameters of the page pipeline, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    input_folder: str = ""
    detection_model_path: str = ""
    recognition_model_path: str = ""
    processor_path: str = ""
    segmentation_model_name: str = "segmentation"
    line_model_name: str = "lines"
    text_model_name: str = "text"
    line_threshold: int = 8
    page_xml: bool = False
    alto_xml: bool = True
    xml_folder: str | None = None
    confidence_threshold: float = 0.15
    new_ordering: bool = False
    line_percentage_threshold: float = 7e-05
    region_percentage_threshold: float = 7e-05
    line_iou: float = 0.3
    region_iou: float = 0.3
    line_overlap_threshold: float = 0.5
    region_overlap_threshold: float = 0.5
    tile_size: int = 0
    tile_overlap: int = 128
    tiles_across: int = 2
    tile_iou_threshold: float = 0.85
    tile_batch_size: int = 6
    text_direction: str = "lr"
    compat: bool = False

    @property
    def max_size(self) -> int:
        """Size images are brought to: the longer side untiled, the shorter side tiled."""
        return self.tile_size * self.tiles_across - self.tile_overlap if self.tile_size else 768
