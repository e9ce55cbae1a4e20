"""Match operators: frames in, frames out; none of them runs an action unless it says so."""
